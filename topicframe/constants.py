"""Names and defaults that outputs and settings must carry.

Everything in this module is a fixed value: attribute names, route names, reserved
words and default limits that a user of the system being matched already relies on.
"""

# --- fixed values: attribute names -------------------------------------------------
MESSAGE_ID_ATTRIBUTE = "pulsar.message.id"
PROPERTY_PREFIX = "pulsar.property."
TOPIC_ATTRIBUTE = "topicName"
SCHEMA_ATTRIBUTE = "avro.schema"
MESSAGE_COUNT_ATTRIBUTE = "message.count"
RECORD_COUNT_ATTRIBUTE = "record.count"
PUBLISHED_COUNT_ATTRIBUTE = "msg.count"
PUBLISHED_TOPIC_ATTRIBUTE = "topic.name"
KEY_ATTRIBUTE = "msg.key"

# --- fixed values: reserved words --------------------------------------------------
KEY_SOURCE = "__KEY__"
SELF_DESCRIBING_SCHEMA_TYPE = "AVRO"

# --- fixed values: routes ----------------------------------------------------------
SUCCESS = "success"
FAILURE = "failure"
PARSE_FAILURE = "parse_failure"

# --- fixed values: subscription types and those that acknowledge one by one --------
EXCLUSIVE = "Exclusive"
SHARED = "Shared"
KEY_SHARED = "Key_Shared"
FAILOVER = "Failover"
SUBSCRIPTION_TYPES = (EXCLUSIVE, SHARED, KEY_SHARED, FAILOVER)
SHARED_TYPES = (SHARED, KEY_SHARED)

# --- fixed values: default limits --------------------------------------------------
DEFAULT_DEMARCATOR = "\n"
DEFAULT_RECEIVE_BATCH = 1000
DEFAULT_PUBLISH_BATCH_MESSAGES = 1000
DEFAULT_PUBLISH_BATCH_BYTES = 131072
DEFAULT_PUBLISH_BATCH_MILLISECONDS = 10
DEFAULT_SENDS_PER_FLUSH = 100
DEFAULT_CHUNK_BYTES = 536870912
DEFAULT_ACK_TIMEOUT_SECONDS = 30
MINIMUM_ACK_TIMEOUT_SECONDS = 10
DEFAULT_CHUNK_EXPIRY_SECONDS = 60
DEFAULT_PENDING_CHUNKED = 10
