"""Fixed values and default parameters."""

# Identifiers, encoder prefix, index schema and cut-offs of the
# screening study whose tables this library reads and writes.
ID_PREFIX = "https://openalex.org/"
ENCODER_PREFIX = "query: "
VECTOR_DIM = 384
MAX_TOKENS = 512
SEARCH_DEPTH = 5000
MIN_YEAR = 2015
CUT_CRITERIA = 1000
CUT_INCLUDED = 427
CUT_RERANK_POOL = 4270
CUT_MASTER = 50
RERANK_KEEP = 7000
RERANK_SEED = 42
EXCLUDED_DOIS = (
    "10.1037/a0020809",
    "10.1097/BCR.0b013e3181cb8ee6",
    "10.1007/s00520-015-2960-x",
    "10.1016/j.pain.2010.02.013",
)
MASTER_FLAGS = (
    "Data_0_Synergy",
    "Data_1_old_replication",
    "Data_2_old_comprehensive",
    "Data_4a_snowballing",
    "Data_3a_inlusion_criteria-corrected",
    "Data_3b_old",
    "Data_3c_active_learning_total1000-corrected",
    "Data_3b",
)
MASTER_OLD_FLAG = "Data_3b_includedrecords_top88-corrected"

# Size bounds behind which a side may be broadcast or held by one task.
BROADCAST_ROWS = 500_000
QUERY_VECTOR_BYTES = 64 * 1024 * 1024
TASK_HITS = 4_000_000
HELD_HITS = 200_000
CHUNK_CELLS = 2_000_000
TASK_BYTES = 1024 * 1024 * 1024
MERGE_ROWS = 4_000_000
MOST_LISTS = 2_000
LIST_BLOCK = 1_000
BLOCK_QUERIES = 4_096
BLOCK_VECTORS = 32_768
BLOCK_CELLS = 32_000_000
PIVOTS = 16
PART_VECTORS = 1_000_000
FIRST_BLOCKS = 64
HOT_ROWS = 1_000_000
LOOKUP_KEYS = 20_000
LOOKUP_VALUES = 200
LOOKUP_GROUP_BYTES = 16 * 1024 * 1024
LOOKUP_PAGE_ROWS = 1_000
