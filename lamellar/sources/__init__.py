"""Sources and sinks: Arrow shards, chunk indexes, volume specs, manifests, profiles, logs and listings."""
