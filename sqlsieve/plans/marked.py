"""Files that differ in one line, with what the rules must say about each, written out by hand.

The verdicts below are not derived from the rule tables, so a wrong word in a table or a fault in the
phrase compiler shows as a difference between the query and its twin. Columns: the line, whether it
marks another dialect, the wanted one and its newer features, the tags, and the first failing rule.
"""

from __future__ import annotations

from .fixtures import _text

PLAIN = ["SELECT a.id, b.name", "FROM dbo.alpha a", "JOIN dbo.beta b ON a.id = b.id", "WHERE a.id = {k}"]
LAST = "ORDER BY a.id;"

ONE_LINE = [
    ("-- nothing of note", 0, 0, 0, "", "dialect"),
    ("GO", 0, 1, 0, "", "kept"),
    ("-- let it go here", 0, 1, 0, "", "kept"),
    ("-- gone category", 0, 0, 0, "", "dialect"),
    ("SELECT x FROM t WITH (NOLOCK)", 0, 1, 0, "", "kept"),
    ("DECLARE @n INT", 0, 1, 0, "", "kept"),
    ("SET @n = 5", 0, 1, 0, "", "kept"),
    ("SELECT @n = 5", 0, 1, 0, "", "kept"),
    ("PRINT x", 0, 1, 0, "", "kept"),
    ("RAISERROR(x, 16, 1)", 0, 1, 0, "", "kept"),
    ("THROW;", 0, 1, 0, "", "kept"),
    ("x NVARCHAR(10)", 0, 1, 0, "", "kept"),
    ("SELECT DATEADD(day, 1, d)", 0, 1, 0, "", "kept"),
    ("SELECT TRY_CAST(x AS INT)", 0, 1, 1, "", "kept"),
    ("SELECT STRING_AGG(x, y)", 0, 1, 1, "", "kept"),
    ("SELECT x FROM OPENJSON(y)", 0, 1, 1, "json", "kept"),
    ("SELECT x FOR JSON AUTO", 0, 1, 1, "json", "kept"),
    ("SELECT x FOR XML PATH", 0, 1, 0, "xml", "kept"),
    ("BEGIN TRY", 0, 1, 1, "try_catch", "kept"),
    ("BEGIN CATCH", 0, 1, 0, "", "kept"),
    ("CROSS APPLY dbo.f(a.id) c", 0, 1, 1, "apply", "kept"),
    ("CREATE PROCEDURE dbo.p", 0, 1, 0, "stored_proc", "kept"),
    ("CREATE PROC dbo.p", 0, 0, 0, "stored_proc", "dialect"),
    ("CREATE OR ALTER FUNCTION dbo.f(x)", 0, 1, 0, "function", "kept"),
    ("CREATE TRIGGER dbo.t", 0, 1, 0, "trigger", "kept"),
    ("CREATE OR ALTER TRIGGER dbo.t", 0, 0, 0, "trigger", "dialect"),
    ("CREATE VIEW dbo.v", 0, 0, 0, "view", "dialect"),
    ("CREATE UNIQUE CLUSTERED INDEX i", 0, 0, 0, "index", "dialect"),
    ("MERGE INTO t USING s", 0, 1, 1, "merge", "kept"),
    ("OFFSET 5 ROWS FETCH NEXT 5 ROWS ONLY", 0, 1, 1, "pagination", "kept"),
    ("OUTPUT DELETED.id", 0, 1, 1, "output_clause", "kept"),
    ("EXEC p 1", 0, 1, 0, "", "kept"),
    ("EXEC (x)", 0, 0, 0, "dynamic_sql", "dialect"),
    ("DECLARE c CURSOR", 0, 0, 0, "cursor", "dialect"),
    ("OPTION (RECOMPILE)", 0, 1, 0, "", "kept"),
    ("SELECT TOP 5 x", 0, 1, 0, "", "kept"),
    ("id INT IDENTITY(1, 1)", 0, 1, 0, "", "kept"),
    ("SUM(x) OVER (ORDER BY y)", 0, 1, 1, "window_functions", "kept"),
    ("SELECT ISNULL(x, 0)", 0, 1, 0, "", "kept"),
    ("SELECT IIF(x, 1, 0)", 0, 1, 1, "", "kept"),
    ("FROM SYS.objects", 0, 1, 0, "", "kept"),
    ("FROM INFORMATION_SCHEMA.TABLES", 0, 1, 0, "", "kept"),
    ("SELECT @@ROWCOUNT", 0, 1, 0, "", "kept"),
    ("SELECT CHOOSE(1, x)", 0, 0, 1, "", "dialect"),
    ("d AT TIME ZONE z", 0, 0, 1, "", "dialect"),
    ("x INT AUTO_INCREMENT, NOLOCK", 1, 1, 0, "", "dialect"),
    ("NOLOCK LIMIT 10", 1, 1, 0, "", "dialect"),
    ("NOLOCK SERIAL", 1, 1, 0, "", "dialect"),
    ("NOLOCK RETURNING id", 1, 1, 0, "", "dialect"),
    ("NOLOCK ON CONFLICT", 1, 1, 0, "", "dialect"),
    ("NOLOCK INSERT OR IGNORE", 1, 1, 0, "", "dialect"),
    ("NOLOCK PRAGMA", 1, 1, 0, "", "dialect"),
    ("NOLOCK pg_sleep", 1, 1, 0, "", "dialect"),
    ("NOLOCK gen_random_uuid()", 1, 1, 0, "", "dialect"),
    ("-- auto-generated GO", 0, 1, 0, "", "autogen"),
    ("-- Do Not Edit", 0, 0, 0, "", "autogen"),
    ("-- generated by tool", 0, 0, 0, "", "autogen"),
    ("-- scaffold", 0, 0, 0, "", "autogen"),
    ("-- migration id: 7", 0, 0, 0, "", "migration"),
    ("-- DBVERSION = 3", 0, 0, 0, "", "migration"),
    ("SELECT x FROM [dbo].[__EFMigrationsHistory]", 0, 0, 0, "", "migration"),
    ("migrationBuilder.Sql(x)", 0, 0, 0, "", "migration"),
    ("SELECT " + 1000 * "x", 0, 0, 0, "", "longest_line"),
]

NO_STATEMENT = ["DECLARE @first INT;", "SET NOCOUNT ON;", "WAITFOR DELAY later;", "DECLARE @second INT;", "DECLARE @k{k} INT;"]
WHOLE = [
    (NO_STATEMENT, 0, 1, 0, "", "statement"),
    (PLAIN[:3] + ["WHERE a.id = {k} GO"], 0, 1, 0, "", "lines"),
    (["SELECT {k} GO"] + 6 * [40 * "("], 0, 1, 0, "", "alnum"),
    (PLAIN + 2 * [990 * "x"] + [LAST], 0, 0, 0, "", "mean_line"),
    (PLAIN + 25 * [900 * "x"] + [LAST], 0, 0, 0, "", "size"),
]

VARIANTS = [(PLAIN + [line, LAST], *rest) for line, *rest in ONE_LINE] + WHOLE
STATEMENT_FREE = len(ONE_LINE)

MARKED_FILES = f"""
  select cast(o_orderkey as bigint) as file_id, o_orderkey % {len(VARIANTS)} as variant,
         concat('src/f', cast(o_orderkey as string), '.sql') as path,
         case o_orderkey % {len(VARIANTS)}
           {' '.join(f'when {i} then {_text(v[0])}' for i, v in enumerate(VARIANTS))} end as content
  from orders"""


def verdicts() -> str:
    """SQL for the expected verdict of a variant."""
    whens = [f"when {i} then '{'|'.join(map(str, v[1:]))}'" for i, v in enumerate(VARIANTS)]
    return f"case variant {' '.join(whens)} end"
