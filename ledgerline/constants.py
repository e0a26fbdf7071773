"""Fixed values that must equal the source system's for results to line up.

Fixed values (names, op codes and defaults of the change-record format):

- envelope fields: before, after, op
- provenance columns: ih_topic, ih_offset, ih_partition, ih_op, ih_datetime, ih_blockid
- changelog provenance columns: ih_topic, ih_partition, ih_offset, ih_op
- op codes: c (create), r (snapshot read), u (update), d (delete)
- upsert ops: c, r, u; delete op: d; plain records carry op c
- landing table suffix: _INGEST
- landing retention: 4 hours
- reload gap: 1800 seconds, compared in whole minutes
- CSV text: fields wrapped in double quotes, quotes doubled, comma separated,
  null as a bare empty field, one line per record ending in a newline
"""

BEFORE = "before"
AFTER = "after"
OP = "op"

IH_TOPIC = "ih_topic"
IH_OFFSET = "ih_offset"
IH_PARTITION = "ih_partition"
IH_OP = "ih_op"
IH_DATETIME = "ih_datetime"
IH_BLOCKID = "ih_blockid"

# Landing-table provenance columns, in the landing table's column order.
IH_COLUMNS = (IH_TOPIC, IH_OFFSET, IH_PARTITION, IH_OP, IH_DATETIME, IH_BLOCKID)
# Changelog (append-only) provenance columns.
CHANGELOG_IH_COLUMNS = (IH_TOPIC, IH_PARTITION, IH_OFFSET, IH_OP)

OP_CREATE = "c"
OP_READ = "r"
OP_UPDATE = "u"
OP_DELETE = "d"
UPSERT_OPS = (OP_CREATE, OP_READ, OP_UPDATE)
DELETE_OPS = (OP_DELETE,)
KNOWN_OPS = UPSERT_OPS + DELETE_OPS
PLAIN_OP = OP_CREATE

INGEST_SUFFIX = "_INGEST"
LANDING_RETENTION = "4 hours"
RELOAD_GAP_SECONDS = 1800

# Source-side column names of a record stream (the shape Spark's Kafka source yields).
TOPIC = "topic"
PARTITION = "partition"
OFFSET = "offset"
TIMESTAMP = "timestamp"
KEY = "key"
VALUE = "value"
