"""Sources.

bronze     schema-on-read Parquet with path lineage, tolerant of missing data
history    earlier silver partitions with a partition cut-off
versions   compacted history snapshots (distinct versions per id)
fixtures   review-shaped frames derived from the test ``documents`` table
"""
