"""Each marker with one text that shows it and one near miss, and every threshold on both sides."""

import random

import pytest
from pyspark.sql import functions as F

from sqlsieve.functions import dialect, quality, rules
from sqlsieve.functions.patterns import ASCII, any_phrase
from sqlsieve.functions.text import split_lines

STRONG = [
    ("x\nGO\ny", "GOAL"), ("go", "a_go"), ("(nolock)", "nolocks"), ("NOEXPAND", "NOEXPANDS"),
    ("option (x)", "option x"), ("TOP 5", "TOP n"), ("top(5)", "stop (5)"),
    ("IDENTITY(1, 1)", "IDENTITY(a, 1)"), ("NVARCHAR(5)", "VARCHAR(5)"),
    ("SET  NOCOUNT\nON", "SET NOCOUNT"), ("XACT_ABORT", "XACT"), ("SET ANSI_NULLS OFF", "ANSI_NULLS"),
    ("SET QUOTED_IDENTIFIER", "QUOTED_IDENTIFIER"), ("PRINT 'x'", "PRINT"), ("RAISERROR(", "RAISE ERROR"),
    ("THROW;", "THROWS"), ("BEGIN TRY", "BEGIN TRYING"), ("BEGIN  CATCH", "BEGINCATCH"),
    ("MERGE a\nUSING b", "USING b MERGE a"), ("OUTPUT INSERTED.x", "OUTPUT INSERTED"),
    ("output deleted.x", "output x"), ("CROSS APPLY f", "CROSS JOIN f"), ("OUTER\tAPPLY", "OUTERAPPLY"),
    ("rank() OVER (x)", "OVERT (x)"), ("PIVOT", "PIVOTS"), ("UNPIVOT", "UNPIVOTED"),
    ("SYS.tables", "SYS. tables"), ("INFORMATION_SCHEMA.COLUMNS", "INFORMATION_SCHEMA"),
    ("sp_help", "asp_help"), ("xp_cmdshell", "exp_1"), ("EXEC foo 1", "EXEC foo"),
    ("EXECUTE foo\n", "EXECUTED foo "), ("CREATE PROCEDURE", "CREATE PROC"),
    ("create or alter procedure", "alter procedure"), ("CREATE FUNCTION", "CREATE FUNCTIONS"),
    ("CREATE OR ALTER FUNCTION", "CREATE OR FUNCTION"), ("CREATE TRIGGER", "CREATE OR ALTER TRIGGER"),
    ("DECLARE @x", "DECLARE x"), ("SELECT @a =1", "SELECT @a"), ("SET @a= 1", "SET a = 1"),
    ("@@ROWCOUNT", "@ROWCOUNT"), ("DATEADD(", "DATEADDS("), ("DATEDIFF", "DATE_DIFF"),
    ("DATENAME", "DATENAMES"), ("DATEPART", "DATEPARTS"), ("CONVERT(int", "CONVERT( 'x'"),
    ("ISNULL (x", "ISNULL x"), ("IIF(", "IIFS("), ("TRY_CAST", "TRYCAST"), ("TRY_CONVERT", "TRY_CON"),
    ("TRY_PARSE", "TRY PARSE"), ("FORMAT(x, 'C')", "FORMAT('x', 'C')"), ("STRING_AGG", "STRINGAGG"),
    ("STRING_SPLIT", "STRING SPLIT"), ("OFFSET 5 ROWS\nFETCH NEXT 5", "FETCH NEXT 5 OFFSET"),
    ("OPENJSON", "OPEN JSON"), ("FOR JSON", "FORJSON"), ("OPENXML", "OPENXMLS"), ("FOR XML", "FOR XMLS"),
]
FOREIGN = [
    ("AUTO_INCREMENT", "AUTO_INCREMENTS"), ("limit 5", "XLIMIT 5"), ("LIMIT\n5", "LIMIT n"),
    ("serial", "serializable"), ("RETURNING", "RETURNS"), ("ON CONFLICT", "ONCONFLICT"),
    ("INSERT OR", "INSERT ORDER"), ("PRAGMA", "PRAGMAS"), ("pg_x", "pgx pg_"),
    ("gen_random_uuid()", "gen_random"),
]
MODERN = [
    ("OVER(", "OVERS("), ("STRING_AGG", "STRING"), ("STRING_SPLIT", "SPLIT"), ("IIF (", "IF ("),
    ("CHOOSE(", "CHOOSE"), ("TRY_CAST", "CAST"), ("TRY_CONVERT", "CONVERT(x"), ("FORMAT(", "FORMAT"),
    ("COMPRESS", "COMPRESSED"), ("DECOMPRESS", "UNCOMPRESS"), ("AT TIME ZONE", "AT TIME"),
    ("FETCH NEXT", "FETCH FIRST"), ("OPENJSON", "JSON"), ("FOR JSON", "FOR XML"),
    ("CROSS APPLY", "APPLY"), ("MERGE x USING", "MERGE x"), ("OUTPUT INSERTED.", "OUTPUT"),
    ("BEGIN TRY", "BEGIN"), ("xWITH a AS (", "WITH AS ("), ("ROW_NUMBER()", "ROW_NUMBER( )"),
    ("RANK ()", "RANKS()"), ("DENSE_RANK()", "DENSE_RANK"), ("NTILE(4", "NTILE"),
]
FEATURES = {
    "stored_proc": [("CREATE PROC x", "CREATE PROCX"), ("create or alter procedure", "alter proc")],
    "function": [("CREATE OR ALTER FUNCTION", "ALTER FUNCTION")],
    "trigger": [("CREATE OR ALTER TRIGGER", "ALTER TRIGGER")],
    "view": [("CREATE VIEW", "CREATE VIEWS")],
    "cte": [("WITH q AS (", "xWITH q AS (")],
    "window_functions": [("OVER (", "OVER x")],
    "try_catch": [("BEGIN TRY", "END TRY")],
    "merge": [("MERGE a\n\nUSING", "MERGED USING")],
    "pivot_unpivot": [("PIVOT", "XPIVOT"), ("UNPIVOT", "UN PIVOTS")],
    "json": [("OPENJSON", "JSON"), ("FOR  JSON", "FOR JSONS")],
    "xml": [("FOR XML", "FOR XMLX"), ("OPENXML", "OPEN XML")],
    "apply": [("OUTER APPLY", "INNER APPLY")],
    "dynamic_sql": [("EXEC (", "EXEC x"), ("execute(", "executes("), ("xsp_executesqlx", "sp_execute")],
    "cursor": [("DECLARE c CURSOR", "DECLARE @c CURSOR")],
    "index": [("CREATE UNIQUE NONCLUSTERED INDEX", "CREATE NONCLUSTERED UNIQUE INDEX"),
              ("CREATE CLUSTERED INDEX", "CREATE COLUMNSTORE INDEX"), ("create index", "drop index")],
    "output_clause": [("OUTPUT DELETED.", "OUTPUT DELETED ")],
    "pagination": [("FETCH NEXT", "FETCHNEXT")],
    "ranking": [("ROW_NUMBER ()", "ROW_NUMBERS()"), ("NTILE (", "TILE (")],
}


@pytest.mark.parametrize(
    "cases, find",
    [(STRONG, "has_dialect_markers"), (FOREIGN, "has_foreign_markers"), (MODERN, "is_modern")],
)
def test_markers(values, cases, find):
    column = getattr(dialect, find)("content")
    hits = values([f"a {hit} b" if not hit.endswith("\n") else f"a {hit}" for hit, _ in cases], column)
    misses = values([miss for _, miss in cases], column)
    assert [c for c, ok in zip(cases, hits) if not ok] == []
    assert [c for c, ok in zip(cases, misses) if ok] == []


def test_features(values):
    cases = [(tag, hit, miss) for tag, pairs in FEATURES.items() for hit, miss in pairs]
    assert list(FEATURES) == [tag for tag, _, _ in rules.FEATURES]
    hits = values([c[1] for c in cases], dialect.feature_tags("content"))
    misses = values([c[2] for c in cases], dialect.feature_tags("content"))
    assert [c for c, tags in zip(cases, hits) if c[0] not in tags] == []
    assert [c for c, tags in zip(cases, misses) if c[0] in tags] == []


def test_unicode_words(values):
    """Letters of any script are word characters; caseless also across odd letters."""
    texts = ["éGO", "GO é", "二PIVOT", "TOP 5", "BEGIN TRY", "ıIF(", "ſTRING_AGG(", "NOLOCK",
             "STRINGſ_AGG", "ſTRING_AGG", "OPENJſON", "FİX PİVOT"]
    found = values(texts, dialect.has_dialect_markers("content"))
    assert found == [False, True, False, True, True, True, True, True, False, True, True, True]
    modern = values(["OPENJſON", "MKERGE", "IİF(", "ııF("], dialect.is_modern("content"))
    assert modern == [True, False, True, True]


def test_score(spark):
    df = spark.createDataFrame(
        [(["stored_proc", "cursor"],), (["unknown", "xml"],), ([],), (None,)], "tags array<string>"
    )
    scores = [r[0] for r in df.select(dialect.feature_score("tags")).collect()]
    assert scores == [11, 2, 0, 0]
    assert sum(w for _, w, _ in rules.FEATURES) == 92


GOOD = "SET NOCOUNT ON;\nSELECT a\nFROM b\nWHERE c = 1\nORDER BY a;"


def padded(n, base=GOOD):
    return base + "\n" + "x" * (n - len(base) - 1)


def reasons(values, rows):
    return values(rows, quality.reject_reason("content", "path"))


def test_size(values):
    long = GOOD + "\n" + "\n".join("y" * 99 for _ in range(220))
    tiny = "GO\nSELECT 1\nSELECT 2\nSELECT 3\n"
    rows = [tiny + "x" * (49 - len(tiny)), tiny + "x" * (50 - len(tiny)), long[:20000], long[:20001],
            tiny + "é" * (49 - len(tiny)), tiny + "é" * (50 - len(tiny)), None]
    assert reasons(values, rows) == ["size", None, None, "size", "size", None, "size"]


def test_lines(values):
    four = "SET NOCOUNT ON; SELECT a, b, c, d\nFROM table_one\nWHERE c = 1\nORDER BY a;"
    rows = [four, four + "\n", four + "\nx", four.replace("\n", "\r\n"), four.replace("\n", "\x0c") + "\x0cx",
            four + "\n\n"]
    assert reasons(values, rows) == ["lines", "lines", None, "lines", None, None]


def test_line_lengths(values):
    def with_line(n):
        return GOOD + "\n" + "z" * n + "\n" + "\n".join("SELECT 1" for _ in range(20))

    five = "\n".join(["SELECT 1 GO"] * 4)
    mean_200 = five + "\n" + "a" * (1000 - 44)
    assert reasons(values, [with_line(1000), with_line(1001), mean_200, mean_200 + "a"]) == [
        None, "longest_line", None, "mean_line"]


def test_alnum_share(values):
    # 5 lines, 100 characters: 4 newlines, letters, the rest punctuation.
    def text(letters):
        words = "GO SELECT 1" + "x" * (letters - 9)
        body = words + "(" * (100 - len(words) - 4)
        return "\n\n\n\n" + body

    assert reasons(values, [text(25), text(24)]) == [None, "alnum"]


def test_comment_share(values):
    code = ["SELECT ISNULL(a, 0) FROM b", "SELECT ISNULL(a, 1) FROM b"]
    three = ["-- a", "  /* b", "\t* c"]
    assert reasons(values, ["\n".join(three + code) + "\n", "\n".join(["-- z", *three, *code]) + "\n"]) == [
        None, "comments"]


def test_generated_header(values):
    def at(line, phrase="do not edit"):
        body = ["SELECT ISNULL(a, 0) FROM b"] * 40
        body[line - 1] = f"SELECT 1 -- {phrase}"
        return "\n".join(body)

    rows = [at(30), at(31), at(1, "Generated  by tool"), at(1, "generated by !"), at(1, "autogenerated"),
            at(1, "auto-generated"), at(1, "auto--generated"), at(1, "unscaffolded"),
            at(1, "This file was generated"), "auto\ngenerated\n" + at(9, "fine"),
            "generated\nby\ntool\n" + at(9, "fine")]
    assert reasons(values, rows) == [
        "autogen", None, "autogen", None, "autogen", "autogen", None, "autogen", "autogen", None, "autogen"]


def test_migrations(values):
    paths = ["a/migrations/x.sql", "migrations/x.sql", "a_migration.sql", "A/Migration/x.sql",
             "a\\Migrations\\x.sql", "Flyway/V1.sql", "x/liquibase.sql", "dbUp.sql", "migration.sql", ""]
    assert reasons(values, [(GOOD, p) for p in paths]) == ["migration", None, "migration", "migration",
        "migration", "migration", "migration", "migration", None, None]
    inside = GOOD + "\n" + "-" * (500 - len(GOOD) - 1 - len("DBVERSION =")) + "DBVERSION ="
    headers = [GOOD + "\n-- Migration  Id : 5", GOOD + "\nmigration id\n= 5", GOOD + "\n-- MigrationBuilder",
               GOOD + "\n-- this migration was auto-generated", GOOD + "\n-- this migration was autogenerated",
               GOOD + "\nDbContext.Database.Migrate", GOOD + "\n[dbo].[__EFMigrationsHistory]",
               GOOD + "\nDBVERSION=1"]
    assert values(headers, quality.is_migration_header("content")) == [
        True, True, True, True, False, True, True, True]
    assert values([inside, "x" + inside], quality.is_migration_header("content")) == [True, False]


def test_dialect_and_statement(values):
    plain = "SELECT a\nFROM b\nWHERE c = 1\nAND d = 2\nORDER BY a, b, c, d"
    schema = "CREATE TABLE t (\n a NVARCHAR(5),\n b int,\n c int,\n d int,\n e int)"
    mixed = GOOD + "\nLIMIT 5"
    rows = [plain, schema, mixed, schema + "\nALTER TABLE t", schema + "\nCREATE  INDEX i"]
    assert reasons(values, rows) == ["dialect", "statement", "dialect", None, None]


def test_many_merges_stay_linear(values):
    text = "MERGE " * 3300
    assert values([text], dialect.is_modern("content")) == [False]


def test_ascii_texts_have_the_same_matches_upper_cased(values):
    """The flavour for upper-cased ASCII texts finds what the Unicode one finds in the texts themselves."""
    rng = random.Random(11)
    words = [w for m, n in STRONG + FOREIGN + MODERN for w in (m, n)]
    glue = [" ", "\n", "\x1c", "\x1f", "_", "9", "(", ".", "\t", "\x0b", "@", "-"]
    texts = ["".join(rng.choice(words) + rng.choice(glue) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    lists = [rules.DIALECT_MARKERS, rules.FOREIGN_MARKERS, rules.MODERN_MARKERS, *[p for _, _, p in rules.FEATURES]]
    lists += [rules.GENERATED_PHRASES, rules.MIGRATION_HEADER_PHRASES]
    text = F.col("content")
    columns = [F.upper(text).rlike(any_phrase(p, ASCII)) == text.rlike(any_phrase(p)) for p in lists]
    assert all(all(r) for r in values(texts + [t.lower() for t in texts], *columns))


def test_notes_of_migrations_and_generators_with_the_folded_text_at_hand(values):
    texts = ["-- migration id: 7", "-- Mıgratıon İd = 7", "x", "this migration was auto-generated", 600 * "-" + "migration id: 7",
             "[dbo].[__efmigrations", "-- generated by tool", 40 * "x\n" + "generated by tool"]
    upper, text = dialect.folded(F.col("content")), F.col("content")
    lines = split_lines(text)
    found = values(
        texts,
        quality.is_migration_header(text, upper) == quality.is_migration_header(text),
        quality.not_generated(lines, upper) == quality.not_generated(lines),
    )
    assert found == [(True, True)] * len(texts)
