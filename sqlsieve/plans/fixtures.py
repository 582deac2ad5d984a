"""Input tables derived from the star schema by SQL that Spark and DuckDB both run.

The given tables hold no SQL text, so the file, repository, index and answer tables that the
library works on are derived from ``orders`` and ``customer``, row for row: their size grows with
those tables. The same text serves the library's queries and, as a leading WITH, their twins.
"""

from __future__ import annotations

TEMPLATES = [
    [
        "CREATE OR ALTER PROCEDURE dbo.usp_{k}", "AS", "SET NOCOUNT ON;", "BEGIN TRY",
        "SELECT TOP (10) * FROM dbo.Orders WITH (NOLOCK) WHERE CustomerId = {c};",
        "END TRY", "BEGIN CATCH", "THROW;", "END CATCH", "GO",
    ],
    [
        "CREATE VIEW dbo.v_{k} AS",
        "SELECT CustomerId, ROW_NUMBER() OVER (PARTITION BY CustomerId ORDER BY OrderDate DESC) AS rn,",
        "       Total, Status, Priority", "FROM dbo.Orders", "WHERE CustomerId > {c}", "GO",
    ],
    [
        "-- mysql dump {k}", "CREATE TABLE t_{k} (id INT AUTO_INCREMENT,", "  v VARCHAR(20));",
        "SELECT * FROM t_{k}", "LIMIT 10;", "-- end of file",
    ],
    [
        "SELECT a.id,", "       b.name", "FROM a", "JOIN b ON a.id = b.id", "WHERE a.id = {k}",
        "ORDER BY a.id;",
    ],
    [
        "-- This file was generated by tool {k}", "SELECT TOP 5 *", "FROM dbo.Orders",
        "WHERE OrderId = {k}", "ORDER BY OrderDate", "GO",
    ],
    [
        "-- note one", "-- note two", "-- note three", "-- note four", "/* note five */",
        "SELECT ISNULL(x, 0) FROM dbo.T{k}", "GO",
    ],
    ["SELECT 1", "GO"],
    [
        "MERGE INTO dbo.Customers AS t", "USING staging.Customers AS s", "ON t.Id = s.Id",
        "WHEN MATCHED THEN UPDATE SET t.Name = s.Name, t.Balance = {c}",
        "OUTPUT INSERTED.Id, DELETED.Id;", "GO",
        "SELECT j.Id, j.Name FROM OPENJSON(@payload) AS j CROSS APPLY dbo.fn_{k}(j.Id) AS f",
        "WHERE f.Total > {c} AND j.Name IS NOT NULL", "GO",
    ],
    [
        "SET NOCOUNT ON;", "DECLARE @cutoff INT = {c};", "UPDATE dbo.Orders",
        "SET Status = CASE WHEN CustomerId = @cutoff THEN 1 ELSE 0 END",
        "WHERE OrderId >= {k} AND OrderId < {k} + 100;",
    ],
    ["CREATE PROC dbo.long_{k} AS", "SET NOCOUNT ON;"]
    + 60 * ["SELECT CustomerId, OrderId, Total FROM dbo.Orders WHERE OrderId = {k};"]
    + ["CREATE PROC dbo.short_{k} AS"]
    + 10 * ["SELECT CustomerId, OrderId, Total FROM dbo.Orders WHERE OrderId = {k};"],
]

# One last line per tag that the templates above do not reach.
SNIPPETS = [
    "CREATE FUNCTION dbo.f(@x INT) RETURNS INT",
    "CREATE OR ALTER TRIGGER dbo.tr ON dbo.T",
    "WITH q AS (SELECT 1 AS a)",
    "PIVOT (SUM(x) FOR y IN ([a]))",
    "CREATE UNIQUE NONCLUSTERED INDEX ix ON dbo.T(a)",
    "EXEC (@sql)",
    "OFFSET 5 ROWS FETCH NEXT 5 ROWS ONLY",
    "FOR XML PATH",
    "DECLARE cur CURSOR",
]

_K = "cast(o_orderkey as string)"
_C = "cast(o_custkey as string)"


def _text(lines: list[str]) -> str:
    """SQL for lines joined by newlines, with the order and customer keys filled in."""
    runs: list[tuple[str, int]] = []
    for line in lines:
        if runs and runs[-1][0] == line:
            runs[-1] = (line, runs[-1][1] + 1)
        else:
            runs.append((line, 1))
    parts = [
        f"'{line}'" if n == 1 else f"concat(repeat(concat('{line}', chr(10)), {n - 1}), '{line}')"
        for line, n in runs
    ]
    return f"replace(replace(concat_ws(chr(10), {', '.join(parts)}), '{{k}}', {_K}), '{{c}}', {_C})"


def _template_case(rich: bool) -> str:
    whens = []
    for i, lines in enumerate(TEMPLATES):
        body = _text(lines)
        if rich and i == 8:
            tails = " ".join(f"when {j} then '{s}'" for j, s in enumerate(SNIPPETS))
            pick = f"case cast(floor(o_orderkey / 10) as bigint) % {len(SNIPPETS)} {tails} end"
            body = f"concat({body}, chr(10), {pick})"
        whens.append(f"when {i} then {body}")
    return f"case o_orderkey % 10 {' '.join(whens)} end"


REPO_NAME = "concat('org', cast({0} % 97 as string), '/db', cast({0} % 13 as string))"

_PATH = f"""case o_custkey % 12
    when 0 then concat('db/migrations/m', {_K}, '.sql')
    when 1 then concat('flyway/V', {_K}, '.sql')
    when 2 then concat('migrations/r', {_K}, '.sql')
    when 3 then concat('docs/n', {_K}, '.md')
    when 4 then concat('Views/v', {_K}, '.VW')
    else concat('src/p', {_K}, '.sql') end"""


def _sql_files(rich: bool) -> str:
    return f"""
  select cast(o_orderkey as bigint) as file_id,
         cast(o_orderkey % 10 as bigint) as tpl,
         {REPO_NAME.format('o_custkey')} as repo_name,
         {_PATH} as path,
         {_template_case(rich)} as content,
         case when o_orderkey % 3 = 0 then 'the-stack-v2-dedup' else 'github-scraped' end as source,
         case when o_orderkey % 3 = 0 then null else cast(o_custkey % 500 as bigint) end as stars
  from orders"""


SQL_FILES = _sql_files(rich=False)
SQL_FILES_RICH = _sql_files(rich=True)

REPOS = f"""
  select repo_name,
         cast((c * 7) % 300 as bigint) as stars,
         case c % 3 when 0 then 'TSQL' when 1 then 'SQL' else 'C#' end as language,
         case c % 5 when 0 then 'sqlserver' when 1 then 'tsql,db' when 2 then 'mssql'
                    when 3 then 'sql-server' else '' end as topics_csv,
         cast((c * 37) % 1500 as int) as pushed_days,
         case when c % 4 = 0 then null else 'mit' end as license,
         c % 4 <> 1 as has_readme,
         cast((c % 5) * 100 as bigint) as tsql_bytes,
         cast((c % 2) * 50 as bigint) as sql_bytes,
         cast((c % 7) * 200 as bigint) as other_bytes,
         c % 6 as root_kind
  from (select {REPO_NAME.format('c_custkey')} as repo_name, min(c_custkey) as c
        from customer group by {REPO_NAME.format('c_custkey')}) as firsts"""

REPO_FILES = """
  select repo_name, path, 'blob' as entry_type, content from sql_files
  union all
  select repo_name,
         case root_kind when 0 then 'db.sqlproj' when 1 then 'tSQLt.class.sql'
                        when 2 then 'model.dacpac' else 'src' end as path,
         case when root_kind in (0, 1, 2) then 'blob' else 'tree' end as entry_type,
         case when root_kind in (0, 1, 2) then 'root file' else null end as content
  from repos"""

INDEX_ROWS = """
  select file_id,
         case when file_id % 50 = 0 then null
              when file_id % 60 = 17 then concat('lost', cast(file_id as string))
              when file_id % 9 = 4 then 'blob-shared'
              else concat('blob', cast(file_id as string)) end as blob_id,
         case when file_id % 9 = 4 then 'utf-8'
              when file_id % 7 = 1 then 'utf-16'
              when file_id % 7 = 2 then 'us-ascii'
              when file_id % 7 = 3 then 'no-such-charset' else 'utf-8' end as src_encoding,
         case when file_id = 1 then 50 when file_id = 2 then 51 when file_id = 5 then 19999
              when file_id = 10 then 20000
              else cast(length(content) as bigint) + 40 end as length_bytes,
         file_id % 20 = 3 as is_vendor,
         case when file_id % 20 = 8 then null else file_id % 20 = 7 end as is_generated,
         path, repo_name,
         case when file_id % 4 = 0 then 'mit' else 'apache-2.0' end as license_name,
         cast(length(content) as bigint) as size
  from sql_files"""

# Answers for a table prompt_keys(prompt_id, file_id); every bucket of file_id / 10 goes wrong in
# its own way, 9 of 20 has no answer at all and 19 of 20 an error.
_BUCKET = "cast(floor(file_id / 10) as bigint) % 10"
_ASK = "concat('Which orders belong to account ', cast(file_id as string), '?')"
_CODE = """concat('SELECT CustomerId, OrderId, Total FROM dbo.Orders WHERE OrderId = ',
      cast(file_id as string), ' AND Total > 0 ORDER BY OrderDate DESC;')"""
_REPLIES = [
    ("0, 1", "concat('INSTRUCTION: ', ask, n, '---', n, '```tsql', n, code, n, '```')"),
    ("2", "concat('INSTRUCTION: ', ask, n, '---', n, '```sql', n, '-- part --- one', n, code, n, '```')"),
    ("3", "concat('Sure. INSTRUCTION: ', ask, n, '---', n, '```', n, code, n, '```', n, 'Done.')"),
    ("4", "concat('REQUEST: ', ask, n, '---', n, '```tsql', n, code, n, '```')"),
    ("5", "concat('INSTRUCTION: ', ask, n, '---', n, '```tsql', n, '-- a trivial step', n, code, n, '```')"),
    ("6", "concat('INSTRUCTION: ', ask, n, '```tsql', n, code, n, '```')"),
    ("7", "concat('INSTRUCTION: ', ask, n, '---', n, '```python', n, code, n, '```')"),
    ("8", """case when file_id % 2 = 0
      then concat('INSTRUCTION: Too few', n, '---', n, '```tsql', n, code, n, '```')
      else concat('INSTRUCTION: ', ask, n, '---', n, '```T-SQL', n, 'SELECT 1;', n, '```') end"""),
]
RESPONSES = f"""
  select prompt_id,
         case bucket {' '.join(f"when {b} then {reply}" for bs, reply in _REPLIES for b in bs.split(', '))} end as response_text,
         case when bucket = 9 then 'Timeout: no answer' end as error
  from (select prompt_id, file_id, {_BUCKET} as bucket, {_ASK} as ask, {_CODE} as code, chr(10) as n
        from prompt_keys
        where cast(floor(file_id / 10) as bigint) % 20 <> 9) as keyed"""

# Staged changes for the upsert question: every fifth customer changed, some new ones.
STAGED = """
  select c_custkey, concat(c_name, ' (new)') as c_name, cast(c_nationkey as int) as c_nationkey,
         c_acctbal + 1 as c_acctbal, c_mktsegment
  from customer where c_custkey % 5 = 0
  union all
  select c_custkey + 1000000000, c_name, c_nationkey, c_acctbal, c_mktsegment
  from customer where c_custkey % 50 = 1"""

# Lines of events with faults of several kinds.
JSON_LINES = """
  select event_id,
         case event_id % 10
           when 0 then concat(props, ' x') when 1 then concat(props, ']')
           when 2 then concat('  ', props, '  ') when 3 then '' when 4 then '{a:1}'
           when 5 then concat('[', props, ',]') when 6 then concat('[', props, ',', props, ']')
           else props end as value
  from events"""
