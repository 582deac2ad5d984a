"""Fixed values of the curation rules: word lists, thresholds, weights, record constants.

Phrase notation used in the lists (compiled by ``patterns.py``):

* a space between words stands for any run of white space;
* ``A/B`` is either word, ``[X Y]`` is optional;
* punctuation that stands alone, such as ``(`` or ``=``, may have white space around it;
* ``<name>`` is a run of letters, digits and underscores, ``<n>`` a run of digits,
  ``<gap>`` a run of white space, ``<one>`` one character other than a newline and ``<opt>`` at
  most one character that ends no line;
* ``A ... B`` is A followed later by B, across lines;
* a word is matched whole; a leading ``~`` lifts that, so it is found inside longer words too.

Letter case never matters.
"""

# --- fixed values: size and shape thresholds -------------------------------------------------
MIN_CHARS = 50
MAX_CHARS = 20_000
MIN_LINES = 5
MAX_LINE_LENGTH = 1000
MAX_MEAN_LINE_LENGTH = 200
MIN_ALNUM_SHARE = 0.25
MAX_COMMENT_SHARE = 0.6
HEADER_LINES = 30
MIGRATION_HEADER_CHARS = 500

# --- fixed values: chunk and answer thresholds -----------------------------------------------
MIN_STORED_CHUNK = 80
MIN_SENT_CHUNK = 150
MAX_CHUNK = 3500
HEAD_LOOKAHEAD_LINES = 5
MAX_CHUNKS_PER_FILE = 3
MIN_QUESTION = 20
MIN_CODE = 80
MAX_PAIRS = 5_000

# --- fixed values: collection limits ---------------------------------------------------------
MAX_REPOS = 2000
MAX_FILES_PER_REPO = 200
MIN_SQL_SHARE = 0.2
DATASET_SHARD_ROWS = 50_000
REPO_SHARD_ROWS = 20_000
RESPLIT_ROWS = 10_000

# --- fixed values: record constants ----------------------------------------------------------
DATASET_SOURCE = "the-stack-v2-dedup"
REPO_SOURCE = "github-scraped"
UNKNOWN_LICENSE = "unknown"

# --- fixed values: file suffixes -------------------------------------------------------------
SQL_SUFFIXES = [".sql", ".tsql", ".prc", ".fnc", ".trg", ".vw"]

# --- fixed values: markers of the wanted dialect, any one suffices ---------------------------
# WITH (NOLOCK) needs no entry of its own: the word NOLOCK covers it.
DIALECT_MARKERS = [
    "GO", "NOLOCK", "NOEXPAND", "NVARCHAR", "XACT_ABORT", "RAISERROR", "THROW",
    "PIVOT", "UNPIVOT", "DATEADD", "DATEDIFF", "DATENAME", "DATEPART",
    "TRY_CAST", "TRY_CONVERT", "TRY_PARSE", "STRING_AGG", "STRING_SPLIT",
    "OPENJSON", "OPENXML", "FOR JSON", "FOR XML",
    "SET NOCOUNT ON", "SET ANSI_NULLS", "SET QUOTED_IDENTIFIER",
    "PRINT <gap>", "BEGIN TRY", "BEGIN CATCH", "CROSS/OUTER APPLY",
    "CREATE [OR ALTER] PROCEDURE", "CREATE [OR ALTER] FUNCTION", "CREATE TRIGGER",
    "MERGE ... USING", "OFFSET ... FETCH NEXT", "OUTPUT INSERTED./DELETED.",
    "EXEC/EXECUTE <name> <gap>",
    "OPTION (", "TOP <n>", "TOP (", "IDENTITY ( <n> , <n> )", "OVER (", "CONVERT ( <name>",
    "ISNULL (", "IIF (", "FORMAT ( <name> ,",
    "SYS.<name>", "INFORMATION_SCHEMA.<name>", "SP_<name>", "XP_<name>",
    "DECLARE @<name>", "SELECT @<name> =", "SET @<name> =", "~@@<name>",
]

# --- fixed values: markers of other dialects, any one excludes a file ------------------------
FOREIGN_MARKERS = [
    "AUTO_INCREMENT", "LIMIT <n>", "SERIAL", "RETURNING", "ON CONFLICT", "INSERT OR",
    "PRAGMA", "PG_<name>", "GEN_RANDOM_UUID",
]

# --- fixed values: markers of the dialect's newer features -----------------------------------
MODERN_MARKERS = [
    "OVER (", "STRING_AGG", "STRING_SPLIT", "IIF (", "CHOOSE (", "TRY_CAST", "TRY_CONVERT",
    "FORMAT (", "COMPRESS", "DECOMPRESS", "AT TIME ZONE", "FETCH NEXT", "OPENJSON", "FOR JSON",
    "CROSS/OUTER APPLY", "MERGE ... USING", "OUTPUT INSERTED./DELETED.", "BEGIN TRY",
    "~WITH <name> AS (", "ROW_NUMBER ()", "RANK ()", "DENSE_RANK ()", "NTILE (",
]

# --- fixed values: feature tags in output order, their markers and their weights -------------
FEATURES = [
    ("stored_proc", 10, ["CREATE [OR ALTER] PROCEDURE/PROC"]),
    ("function", 9, ["CREATE [OR ALTER] FUNCTION"]),
    ("trigger", 8, ["CREATE [OR ALTER] TRIGGER"]),
    ("view", 3, ["CREATE [OR ALTER] VIEW"]),
    ("cte", 7, ["WITH <name> AS ("]),
    ("window_functions", 7, ["OVER ("]),
    ("try_catch", 6, ["BEGIN TRY"]),
    ("merge", 6, ["MERGE ... USING"]),
    ("pivot_unpivot", 5, ["PIVOT", "UNPIVOT"]),
    ("json", 5, ["OPENJSON", "FOR JSON"]),
    ("xml", 2, ["FOR XML", "OPENXML"]),
    ("apply", 5, ["CROSS/OUTER APPLY"]),
    ("dynamic_sql", 4, ["EXEC/EXECUTE (", "~sp_executesql"]),
    ("cursor", 1, ["DECLARE <name> CURSOR"]),
    ("index", 4, ["CREATE [UNIQUE] [CLUSTERED/NONCLUSTERED] INDEX"]),
    ("output_clause", 4, ["OUTPUT INSERTED./DELETED."]),
    ("pagination", 3, ["FETCH NEXT"]),
    ("ranking", 3, ["ROW_NUMBER ()", "RANK ()", "DENSE_RANK ()", "NTILE ("]),
]

# --- fixed values: traces of schema migrations and of generators -----------------------------
MIGRATION_PATH_PARTS = [
    "/migrations/", "\\migrations\\", "_migration", "/migration/", "flyway", "liquibase", "dbup",
]
MIGRATION_HEADER_PHRASES = ["~migration id :/=", "~DBVERSION ="]
MIGRATION_HEADER_TEXTS = [
    "migrationbuilder", "This migration was auto<one>generated", "DbContext.Database.Migrate",
    "[dbo].[__EFMigrations",
]
GENERATED_PHRASES = [
    "~generated by <name>", "~do not edit", "~auto<opt>generated", "~scaffold",
    "~this file was generated",
]

# --- fixed values: statements that make a file or a batch worth keeping ----------------------
FILE_STATEMENTS = [
    "SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "EXEC/EXECUTE",
    "CREATE PROCEDURE/PROC/FUNCTION/TRIGGER/VIEW/INDEX",
    "ALTER PROCEDURE/PROC/FUNCTION/TRIGGER/TABLE",
]
BATCH_STATEMENTS = ["SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "CREATE", "ALTER", "EXEC"]
BATCH_SEPARATOR = "GO"
OBJECT_HEAD = "CREATE/ALTER [OR ALTER] PROCEDURE/PROC/FUNCTION/TRIGGER/VIEW <gap>"

# --- fixed values: starts of comment lines ---------------------------------------------------
COMMENT_STARTS = ["--", "/*", "*"]

# --- fixed values: answer format -------------------------------------------------------------
ANSWER_MARKER = "INSTRUCTION:"
ANSWER_DIVIDER = "---"
CODE_FENCE = "```"
FENCE_LANGUAGES = ["tsql", "sql", "t-sql"]
OUTPUT_FENCE_LANGUAGE = "tsql"
LOW_CONFIDENCE_TEXTS = [
    "I'm not sure", "I am not sure", "unclear", "cannot determine", "not enough context",
    "too short", "trivial", "arbitrary", "meaningless", "no business",
]

# --- fixed values: chat text format ----------------------------------------------------------
CHAT_START = "<|im_start|>"
CHAT_END = "<|im_end|>"
CHAT_ROLES = ["user", "assistant"]

# --- fixed values: repository search rules, in order -----------------------------------------
# (language, more stars than, pushed after, topic)
REPO_RULES = [
    ("TSQL", 50, "2023-01-01", None),
    ("TSQL", 20, "2023-01-01", "sqlserver"),
    ("TSQL", 20, "2023-01-01", "tsql"),
    ("TSQL", 20, "2023-01-01", "mssql"),
    ("SQL", 100, "2023-01-01", "sqlserver"),
    ("SQL", 100, "2023-01-01", "sql-server"),
    ("SQL", 50, "2023-01-01", "mssql"),
    ("SQL", 50, "2023-01-01", "tsql"),
    ("TSQL", 10, "2022-01-01", None),
]
SQL_LANGUAGES = ["TSQL", "SQL"]
PROJECT_FILE_ENDINGS = [".sqlproj", ".dacpac"]
PROJECT_NAME_PART = "tsqlt"
