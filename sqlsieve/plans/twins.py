"""SQL twins of the queries, for an engine with RE2 regexes and list lambdas."""

from __future__ import annotations

from ..functions import rules
from ..functions.patterns import RE2, any_phrase, any_text, either, phrase
from ..operators.prompts import TEMPLATE, TEMPLATE_VERSION
from . import fixtures


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def matches(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {text(pattern)})"


def finds(column: str, phrases: list[str]) -> str:
    return matches(column, any_phrase(phrases, RE2))


FOREIGN = finds("content", rules.FOREIGN_MARKERS)
STRONG = finds("content", rules.DIALECT_MARKERS)
DIALECT = f"(not {FOREIGN} and {STRONG})"
MODERN = finds("content", rules.MODERN_MARKERS)
STATEMENT = finds("content", rules.FILE_STATEMENTS)
TAGS = "concat_ws(',', " + ", ".join(
    f"case when {finds('content', ps)} then '{tag}' end" for tag, _, ps in rules.FEATURES
) + ")"
SCORE = "(" + " + ".join(
    f"case when {finds('content', ps)} then {w} else 0 end" for _, w, ps in rules.FEATURES
) + ")"

LINES = "string_split(content, chr(10))"
LONGEST = f"list_max(list_transform({LINES}, lambda x: length(x)))"
MEAN = f"(list_sum(list_transform({LINES}, lambda x: length(x))) / len({LINES}))"
COMMENTS = (
    f"len(list_filter({LINES}, lambda x: regexp_matches(x, '^[ \\t]*(--|/\\*|\\*)')))"
)
ALNUM = "(length(regexp_replace(content, '[^\\p{L}\\p{N}]', '', 'g')) / greatest(length(content), 1))"
HEAD = f"array_to_string(list_slice({LINES}, 1, {rules.HEADER_LINES}), chr(10))"
GENERATED = finds(HEAD, rules.GENERATED_PHRASES)
MIGRATION_PATH = "(" + " or ".join(
    f"contains(lower(path), {text(p)})" for p in rules.MIGRATION_PATH_PARTS
) + ")"
MIGRATION_HEADER = matches(
    f"substring(content, 1, {rules.MIGRATION_HEADER_CHARS})",
    either(
        any_phrase(rules.MIGRATION_HEADER_PHRASES, RE2),
        any_text(rules.MIGRATION_HEADER_TEXTS, RE2),
        fl=RE2,
    ),
)
MIGRATION = f"({MIGRATION_PATH} or {MIGRATION_HEADER})"
SUFFIX = "lower(regexp_extract(path, '^(?:.*/)?[^/]+(\\.[^./]+)$', 1))"
IS_SQL = f"{SUFFIX} in ({', '.join(map(text, rules.SQL_SUFFIXES))})"

REASON = f"""case
    when not length(content) between {rules.MIN_CHARS} and {rules.MAX_CHARS} then 'size'
    when len({LINES}) < {rules.MIN_LINES} then 'lines'
    when {LONGEST} > {rules.MAX_LINE_LENGTH} then 'longest_line'
    when {MEAN} > {rules.MAX_MEAN_LINE_LENGTH} then 'mean_line'
    when {ALNUM} < {rules.MIN_ALNUM_SHARE} then 'alnum'
    when {COMMENTS} / len({LINES}) > {rules.MAX_COMMENT_SHARE} then 'comments'
    when {GENERATED} then 'autogen'
    when {MIGRATION} then 'migration'
    when not {DIALECT} then 'dialect'
    when not {STATEMENT} then 'statement' end"""

_STRIP = "chr(10) || chr(13) || chr(9) || ' '"
_BATCHES = f"""list_filter(
    list_transform(string_split_regex(content, '(?im)^[ \\t\\r]*GO[ \\t\\r]*$'), lambda x: trim(x, {_STRIP})),
    lambda x: length(x) between {rules.MIN_STORED_CHUNK} and {rules.MAX_CHUNK}
              and {finds('x', rules.BATCH_STATEMENTS)})"""
_HEAD_LINE = matches("line", "(?i)^\\s*" + phrase(rules.OBJECT_HEAD, RE2))


def _chunk_parts(source: str) -> dict[str, str]:
    """CTEs from ``source(file_id, content)`` to ``chunks(file_id, chunk_no, chunk)``."""
    return {
        "batches": f"select file_id, content, {_BATCHES} as parts from {source}",
        "raw_lines": """
            select file_id, unnest(string_split(content, chr(10))) as line,
                   generate_subscripts(string_split(content, chr(10)), 1) - 1 as i,
                   len(string_split(content, chr(10))) as n
            from batches where len(parts) = 0""",
        "file_lines": f"""
            select file_id, i, length(line) + case when i < n - 1 then 1 else 0 end as chars,
                   {_HEAD_LINE.replace('(line,', "(line || case when i < n - 1 then chr(10) else '' end,")} as head
            from raw_lines""",
        "scan": f"""
            select file_id, 0 as i, 0 as pos, -1 as open_at, 0 as open_no,
                   -1 as piece_at, 0 as piece_chars
            from batches where len(parts) = 0
            union all
            select file_id, i + 1, pos + chars,
                   case when head and (ends or open_at < 0) then pos when ends then -1 else open_at end,
                   case when head and (ends or open_at < 0) then i else open_no end,
                   case when ends then open_at else -1 end, case when ends then pos - open_at else 0 end
            from (select s.*, l.chars, l.head,
                         s.open_at >= 0 and (s.pos - s.open_at >= {rules.MAX_CHUNK}
                           or (l.head and l.i > s.open_no + {rules.HEAD_LOOKAHEAD_LINES})) as ends
                  from scan s join file_lines l on l.file_id = s.file_id and l.i = s.i) as stepped""",
        "pieces": f"""
            select b.file_id, p.begins, trim(substring(b.content, p.begins + 1, p.chars), {_STRIP}) as chunk
            from batches b join (
              select file_id, piece_at as begins, piece_chars as chars from scan where piece_at >= 0
              union all
              select s.file_id, s.open_at, s.pos - s.open_at from scan s
              join (select file_id, max(i) as i from scan group by file_id) e
                on e.file_id = s.file_id and e.i = s.i
              where s.open_at >= 0) p on p.file_id = b.file_id""",
        "objects": f"""
            select file_id, cast(row_number() over (partition by file_id order by begins) as int) as chunk_no, chunk
            from pieces where length(chunk) >= {rules.MIN_STORED_CHUNK}""",
        "chunks": f"""
            select file_id, cast(unnest(generate_series(1, len(parts))) as int) as chunk_no,
                   unnest(parts) as chunk
            from batches where len(parts) > 0
            union all
            select file_id, chunk_no, chunk from objects
            union all
            select file_id, cast(1 as int), trim(content, {_STRIP}) from batches
            where len(parts) = 0 and length(content) between {rules.MIN_STORED_CHUNK} and {rules.MAX_CHUNK}
              and file_id not in (select file_id from objects)""",
    }


_BEFORE = "substring(response_text, 1, strpos(response_text, '---') - 1)"
_AFTER = "substring(response_text, strpos(response_text, '---') + 3)"
_QUESTION = f"trim(replace({_BEFORE}, 'INSTRUCTION:', ''), {_STRIP})"
_ANSWER_CODE = f"""trim(regexp_extract({_AFTER},
    '(?is)```(?:tsql|sql|t-sql)?\\n(.*?)```', 1), {_STRIP})"""
_ACCEPTED = f"""(contains(response_text, 'INSTRUCTION:') and contains(response_text, '---')
    and not {matches('response_text', any_text(rules.LOW_CONFIDENCE_TEXTS, RE2))}
    and length({_QUESTION}) >= {rules.MIN_QUESTION} and length({_ANSWER_CODE}) >= {rules.MIN_CODE})"""

RANK = "is_modern desc, is_repo desc, feature_score desc, n_stars desc, repo_name, path"

PARTS = {
    "sql_files": fixtures.SQL_FILES,
    "sql_files_rich": fixtures.SQL_FILES_RICH,
    "repos": fixtures.REPOS,
    "repo_files": fixtures.REPO_FILES,
    "index_rows": fixtures.INDEX_ROWS,
    "judged": f"select *, {REASON} as reject_reason from sql_files",
    "found": f"""
        select repo_name, stars, license, has_readme, tsql_bytes, sql_bytes, other_bytes, root_kind,
               unnest(list_filter([{', '.join(
                   "case when language = " + text(lang) + f" and stars > {stars}"
                   + f" and date '2021-06-01' + pushed_days > date '{day}'"
                   + (f" and list_contains(string_split(topics_csv, ','), {text(topic)})" if topic else "")
                   + f" then {i} end"
                   for i, (lang, stars, day, topic) in enumerate(rules.REPO_RULES, start=1))}],
                 lambda x: x is not null)) as rule
        from repos""",
    "first_hits": """
        select repo_name, min(rule) as rule, any_value(stars) as stars, any_value(license) as license,
               any_value(has_readme) as has_readme, any_value(tsql_bytes) as tsql_bytes,
               any_value(sql_bytes) as sql_bytes, any_value(other_bytes) as other_bytes,
               any_value(root_kind) as root_kind
        from found group by repo_name""",
    "corpus": f"""
        select *, {TAGS} as tags, {SCORE} as feature_score,
               case when source = 'github-scraped' then {MODERN} end as modern_tsql,
               case when source = 'github-scraped' and {MODERN} then 1 else 0 end as is_modern,
               case when source = 'github-scraped' then 1 else 0 end as is_repo,
               coalesce(stars, 0) as n_stars
        from judged where reject_reason is null and {IS_SQL}""",
    **_chunk_parts("corpus"),
    "prompts": f"""
        select sha256(concat('{TEMPLATE_VERSION}', chr(0), sha256({text(TEMPLATE)}), chr(0), chunk)) as prompt_id, c.file_id, chunk_no,
               replace({text(TEMPLATE)}, '{{code}}', chunk) as prompt,
               repo_name, path, source, modern_tsql, tags, is_modern, is_repo, feature_score, n_stars
        from chunks c join corpus f on f.file_id = c.file_id
        where length(chunk) >= {rules.MIN_SENT_CHUNK}""",
    "prompt_keys": "select prompt_id, min(file_id) as file_id from prompts group by prompt_id",
    "responses": fixtures.RESPONSES,
    "outcomes": f"""
        select p.*, r.response_text,
               case when r.error is not null then 'error' when r.response_text is null then 'missing'
                    when {_ACCEPTED} then 'accepted' else 'unparsable' end as outcome,
               {_QUESTION} as instruction, {_ANSWER_CODE} as code
        from prompts p left join responses r on r.prompt_id = p.prompt_id""",
    "staged": fixtures.STAGED,
    "json_lines": fixtures.JSON_LINES,
    "now_is": "select max(o_orderdate) as now from orders",
}

_NEEDS = {
    "judged": ["sql_files"],
    "repo_files": ["sql_files", "repos"],
    "index_rows": ["sql_files"],
    "found": ["repos"],
    "first_hits": ["found"],
    "corpus": ["judged"],
    "batches": ["corpus"],
    "raw_lines": ["batches"],
    "file_lines": ["raw_lines"],
    "scan": ["file_lines"],
    "pieces": ["scan"],
    "objects": ["pieces"],
    "chunks": ["objects"],
    "prompts": ["chunks"],
    "prompt_keys": ["prompts"],
    "responses": ["prompt_keys"],
    "outcomes": ["responses"],
}


def twin(body: str, *names: str, **own: str) -> str:
    """``body`` with the named CTEs, and those that they need, in front; ``own`` replaces some."""
    parts = {**PARTS, **own}
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return body
    return "with recursive " + ",\n".join(f"{n} as ({parts[n]})" for n in order) + "\n" + body
