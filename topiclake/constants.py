"""Type names, limits, messages and file-name formats users of the tables rely on."""

FIELD_TYPES = ["STRING", "INT", "LONG", "FLOAT", "DOUBLE", "BOOLEAN"]
SINK_FORMATS = ["PARQUET", "CSV"]
PARQUET_CODECS = ["SNAPPY", "GZIP", "ZSTD", "NONE"]
CSV_CODECS = ["GZIP", "NONE"]
VALIDATED_CODECS = ["SNAPPY", "GZIP", "NONE"]
MATCH_TYPES = ["EXACT", "REGEX"]

MAX_TOPIC_NAME = 255
MAX_SINK_PATH = 512
MAX_SCHEMA_JSON = 32768
MAX_DESCRIPTION = 512
MAX_REGEX = 128
SAMPLE_CHARS = 200

SAFE_TOPIC = r"^[a-zA-Z0-9._\-]+$"
UNSAFE_PATH_CHAR = r"[^a-zA-Z0-9_.\-]"
NESTED_QUANTIFIER = r".*\(([^)]*[+*]){2,}.*"
QUANTIFIED_GROUP = r"\([^()]*[+*][^()]*\)[+*{]"

FILE_NAME = r"^part-(.+)-P(\d+)-(\d+)to(\d+)-(\d{14})\.(.+)$"

ONLINE_WINDOW_SEC = 60
NEW_TOPIC_GRACE_SEC = 60
THROTTLE_ON = 0.9
THROTTLE_OFF = 0.8
CRITICAL_AT = 1.0
MIN_FILE_BYTES = 128 * 1024 * 1024
MAX_FILE_BYTES = 512 * 1024 * 1024
PARQUET_BLOCK_BYTES = 128 * 1024 * 1024
PARQUET_PAGE_BYTES = 1024 * 1024
