"""Schemas of the data model (Spark DDL strings)."""

SEED_DDL = "url string"                                               # M1
FETCHED_DDL = "url string, content_type string, body binary"          # M2
VISITED_DDL = "url string"                                            # M3
FRONTIER_DDL = "url string, depth int"                                # M4
LINK_DDL = "src string, pos bigint, href string, dst string"          # M5
RECORD_DDL = "url string, text string"                                # M6
CHUNK_DDL = "ord bigint, chunk_no bigint, url string, data string"   # M8
QA_DDL = "ord bigint, chunk_no bigint, question_no bigint, question string, answer string"  # M9
MESSAGES_TYPE = "array<struct<role:string,content:string>>"
EXAMPLE_DDL = f"messages {MESSAGES_TYPE}"                             # M10
BLOCK_DDL = "url string, pos bigint, tag string, text string"
PAGE_TEXT_DDL = "url string, page_no bigint, text string"
EXPORT_DDL = "file_key string, text string"                           # M13
