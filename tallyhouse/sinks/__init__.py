from tallyhouse.sinks.write import Mode, day_partition, namespace, write  # noqa: F401
