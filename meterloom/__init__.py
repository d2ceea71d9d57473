"""Usage-metering analytics on Spark: logs to facts, facts to five-minute slots, slots and meter readings to analyses."""
