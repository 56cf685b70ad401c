"""Column names and schemas shared by all operators."""

# Column names of the flat order table and of the stores.
ID = "id"
SHOP_ID = "shop_id"
RECEIVE_TIME = "receive_time"
ORDER_TIMESTAMP = "order_timestamp"
SHOP_NAME = "shop_name"
YEAR = "year"
WEEK_NUMBER = "week_number"

# Dictionary columns.
DICTIONARY_ID = "id"
DICTIONARY_NAME = "name"

# The two stores a batch is routed to.
SUCCESS = "success"
FAILED = "failed"
QUARANTINE = "quarantine"

# Fixed value: JSON schema of one message.
PAYLOAD_DDL = "id LONG, timestamp TIMESTAMP, shopId LONG"

# Technical columns: where a message lies in its log, and how many copies of an
# order its surviving row stands for.
TOPIC = "topic"
PARTITION = "partition"
OFFSET = "offset"
COPIES = "copies"
ROUTE = "route"

POSITION = [PARTITION, OFFSET]
PLACE = [TOPIC, *POSITION]
STORE_PARTITIONS = [YEAR, WEEK_NUMBER]
STORE_KEY = [ID, YEAR, WEEK_NUMBER]
FLAT_COLUMNS = [ID, SHOP_ID, RECEIVE_TIME, ORDER_TIMESTAMP, YEAR, WEEK_NUMBER]
RESULT_COLUMNS = [RECEIVE_TIME, ID, ORDER_TIMESTAMP, SHOP_NAME, YEAR, WEEK_NUMBER]

LOG_DDL = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset LONG, timestamp TIMESTAMP"
)
RESULT_DDL = (
    "receive_time TIMESTAMP, id LONG, order_timestamp TIMESTAMP, shop_name STRING, "
    "year INT, week_number INT"
)
# The failed store also says where each row came from, so that a replay can be told.
FAILED_DDL = f"{RESULT_DDL}, topic STRING, partition INT, offset LONG"
OFFSET_STATE_DDL = "topic STRING, partition INT, offset LONG, batch_id LONG"
OFFSET_DOCUMENT_DDL = (
    "topic STRING, partitionDataList ARRAY<STRUCT<partitionIndex: STRING, offset: LONG>>"
)
