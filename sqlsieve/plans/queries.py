"""Named queries over the given tables, each with its SQL twin where one is practical."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import answers, chat, chunking, dialect, quality, rules
from ..functions import text as measures
from ..functions.text import let, split_lines
from ..operators import corpus, gold, prompts, ranking, report, repos
from ..operators.numbering import assign_parts
from ..operators.packing import pack_groups
from ..operators.user_code import keep_if, map_batches
from ..session import new_table_path, spread, tasks_for
from ..sources import blobs, commits, jsonl, shards, sinks
from ..streaming import collect
from . import marked, twins
from .tables import Tables, listed
from .twins import twin


class Query(NamedTuple):
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}
REPO_CAP = 60
FILE_CAP = 5
PAIR_CAP = 1000


def query(sql: str | None = None):
    def register(run: Callable[[Tables], DataFrame]):
        REGISTRY[run.__name__] = Query(run, sql)
        return run

    return register


# --- dialect, features, weights --------------------------------------------------------------


@query(twin(
    f"""select foreign_marker, dialect_marker, count(*) as n_files from (
          select {twins.FOREIGN} as foreign_marker, {twins.STRONG} as dialect_marker from sql_files) f
        group by foreign_marker, dialect_marker""",
    "sql_files",
))
def dialect_split(t: Tables) -> DataFrame:
    return (
        t.sql_files()
        .select(
            dialect.has_foreign_markers("content").alias("foreign_marker"),
            dialect.has_dialect_markers("content").alias("dialect_marker"),
        )
        .groupBy("foreign_marker", "dialect_marker")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )


@query(twin(f"select file_id from sql_files where {twins.FOREIGN}", "sql_files"))
def foreign_marker_hits(t: Tables) -> DataFrame:
    return t.sql_files().where(dialect.has_foreign_markers("content")).select("file_id")


@query(twin(f"select file_id, path from sql_files where {twins.DIALECT}", "sql_files"))
def dialect_files(t: Tables) -> DataFrame:
    return t.sql_files().where(dialect.is_dialect("content")).select("file_id", "path")


@query(twin(
    f"""select source, count(*) as n_files,
               sum(case when {twins.MODERN} then 1 else 0 end)::bigint as n_modern
        from sql_files group by source""",
    "sql_files",
))
def modern_share(t: Tables) -> DataFrame:
    return (
        t.sql_files()
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.count_if(dialect.is_modern("content")).alias("n_modern"),
        )
    )


@query(twin(f"select file_id, {twins.TAGS} as tags from sql_files_rich", "sql_files_rich"))
def feature_tags(t: Tables) -> DataFrame:
    return t.sql_files(rich=True).select(
        "file_id", listed(dialect.feature_tags("content")).alias("tags")
    )


@query(twin(
    f"""select tag, count(*) as n_files from (
          select unnest(string_split({twins.TAGS}, ',')) as tag from sql_files_rich) f
        where tag <> '' group by tag""",
    "sql_files_rich",
))
def feature_counts(t: Tables) -> DataFrame:
    tags = t.sql_files(rich=True).select(F.explode(dialect.feature_tags("content")).alias("tag"))
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n_files"))


@query(twin(f"select file_id, {twins.SCORE} as feature_score from sql_files_rich", "sql_files_rich"))
def feature_score(t: Tables) -> DataFrame:
    tagged = t.sql_files(rich=True).select("file_id", dialect.feature_tags("content").alias("tags"))
    return tagged.select("file_id", dialect.feature_score("tags").alias("feature_score"))


@query(f"select file_id, {marked.verdicts()} as verdict from ({marked.MARKED_FILES}) m")
def marked_files(t: Tables) -> DataFrame:
    """What the rules say about files that differ in one line, against what was written down."""
    judged = corpus.judged(t.sql(marked.MARKED_FILES, orders=spread(t("orders"))))
    flag = lambda c: c.cast("int").cast("string")
    verdict = F.concat_ws(
        "|",
        flag(dialect.has_foreign_markers("content")), flag(dialect.has_dialect_markers("content")),
        flag(dialect.is_modern("content")), listed(dialect.feature_tags("content")),
        F.coalesce("reject_reason", F.lit("kept")),
    )
    return judged.select("file_id", verdict.alias("verdict"))


@query(
    f"""select file_id, content as chunk from ({marked.MARKED_FILES}) m
        where variant = {marked.STATEMENT_FREE}"""
)
def statement_free_chunk(t: Tables) -> DataFrame:
    """Files without any statement are one chunk each, whole."""
    files = t.sql(marked.MARKED_FILES, orders=t("orders")).where(
        F.col("variant") == marked.STATEMENT_FREE
    )
    return files.select("file_id", F.explode(chunking.extract_chunks("content")).alias("chunk"))


# --- size, lines, quality --------------------------------------------------------------------

_DOCUMENTS = "(select doc_id, text as content, '' as path from documents) d"


def _documents(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", F.col("text").alias("content"), F.lit("").alias("path"))


@query(
    f"""select doc_id, cast(length(content) as int) as n_chars, cast(len({twins.LINES}) as int) as n_lines,
               cast({twins.LONGEST} as int) as longest, round({twins.MEAN}, 6) as mean_length
        from {_DOCUMENTS}"""
)
def size_line_stats(t: Tables) -> DataFrame:
    stats = measures.line_stats("content")
    return (
        _documents(t)
        .select("doc_id", F.length("content").alias("n_chars"), stats.alias("s"))
        .select("doc_id", "n_chars", "s.n_lines", "s.longest", F.round("s.mean_length", 6).alias("mean_length"))
    )


@query(f"select doc_id, round({twins.ALNUM}, 6) as alnum_share from {_DOCUMENTS}")
def alnum_ratio(t: Tables) -> DataFrame:
    share = measures.alnum_share("content")
    return _documents(t).select("doc_id", F.round(share, 6).alias("alnum_share"))


@query(twin(
    f"""select file_id, cast({twins.COMMENTS} as int) as n_comments,
               round({twins.COMMENTS} / len({twins.LINES}), 6) as share from sql_files""",
    "sql_files",
))
def comment_ratio(t: Tables) -> DataFrame:
    both = let(
        split_lines("content"),
        lambda a: F.struct(
            measures.comment_lines(a).alias("n_comments"),
            F.round(measures.comment_share(a), 6).alias("share"),
        ),
    )
    return t.sql_files().select("file_id", both.alias("c")).select("file_id", "c.*")


@query(twin(f"select file_id from sql_files where {twins.GENERATED}", "sql_files"))
def autogen_header(t: Tables) -> DataFrame:
    generated = ~let(split_lines("content"), quality.not_generated)
    return t.sql_files().where(generated).select("file_id")


@query(twin(
    f"""select file_id, {twins.MIGRATION_PATH} as by_path, {twins.MIGRATION_HEADER} as by_header
        from sql_files where {twins.MIGRATION}""",
    "sql_files",
))
def migration_filter(t: Tables) -> DataFrame:
    return (
        t.sql_files()
        .where(quality.is_migration("path", "content"))
        .select(
            "file_id",
            quality.is_migration_path("path").alias("by_path"),
            quality.is_migration_header("content").alias("by_header"),
        )
    )


@query(twin(f"select file_id from sql_files where {twins.STATEMENT}", "sql_files"))
def statement_filter(t: Tables) -> DataFrame:
    return t.sql_files().where(quality.has_statement("content")).select("file_id")


@query(twin(f"select file_id, path from sql_files where {twins.IS_SQL}", "sql_files"))
def suffix_filter(t: Tables) -> DataFrame:
    return t.sql_files().where(repos.is_sql_path("path")).select("file_id", "path")


_FUNNEL = "coalesce(reject_reason, 'kept') as outcome, count(*) as n_files"


@query(twin(f"select {_FUNNEL} from judged group by coalesce(reject_reason, 'kept')", "judged"))
def quality_funnel(t: Tables) -> DataFrame:
    return report.funnel(corpus.judged(t.sql_files()))


@query(f"select doc_id, coalesce({twins.REASON}, 'kept') as outcome from {_DOCUMENTS}")
def document_outcomes(t: Tables) -> DataFrame:
    outcome = F.coalesce("reject_reason", F.lit("kept")).alias("outcome")
    return corpus.judged(_documents(t)).select("doc_id", outcome)


@query(twin("select file_id from judged where reject_reason is null", "judged"))
def kept_files(t: Tables) -> DataFrame:
    return corpus.kept(t.sql_files()).select("file_id")


@query(twin(
    """select count(*) as seen, count(*) filter (reject_reason is null) as kept,
              count(*) filter (reject_reason is null) / count(*) as rate from judged""",
    "judged",
))
def pass_rate(t: Tables) -> DataFrame:
    return report.pass_rate(corpus.judged(t.sql_files()))


# --- dataset index and contents --------------------------------------------------------------

_SMALL = """length_bytes > 50 and length_bytes < 20000 and not coalesce(is_vendor, false)
            and not coalesce(is_generated, false)"""
# Every index row whose blob exists and decodes: ascii and utf-16 contents are as they were.
_CONTENTS = f"""
    select i.file_id, i.path, i.repo_name, [i.license_name] as detected_licenses, i.size,
           i.license_name, f.content
    from index_rows i join sql_files f on f.file_id = case when i.blob_id = 'blob-shared' then 0 else i.file_id end
    where {_SMALL} and i.blob_id is not null and i.blob_id not like 'lost%'
      and (i.blob_id = 'blob-shared'
           or ((i.file_id % 40 <> 11 or i.src_encoding = 'utf-16') and i.src_encoding <> 'no-such-charset'))"""


@query(twin(f"select file_id, blob_id from index_rows where {_SMALL} and blob_id <> ''", "index_rows"))
def metadata_prefilter(t: Tables) -> DataFrame:
    return corpus.with_blob(corpus.small_enough(t.index())).select("file_id", "blob_id")


@query(twin("select file_id, cast(length(content) as int) as n_chars, md5(content) as digest from contents",
            "index_rows", "contents", contents=_CONTENTS))
def blob_contents(t: Tables) -> DataFrame:
    files = blobs.attach_content(t.index(), t.blob_store())
    return files.select("file_id", F.length("content").alias("n_chars"), F.md5("content").alias("digest"))


@query(twin(
    f"""select path, repo_name, license_name as license, size, 'the-stack-v2-dedup' as source,
               {twins.TAGS} as tags, md5(content) as digest
        from (select *, {twins.REASON} as reject_reason from contents) j where reject_reason is null""",
    "index_rows", "contents", contents=_CONTENTS,
))
def dataset_records(t: Tables) -> DataFrame:
    records = blobs.collect_dataset(t.index(), t.blob_store())
    return records.select(
        "path", "repo_name", listed("license").alias("license"), "size", "source",
        listed("tsql_features").alias("tags"), F.md5("content").alias("digest"),
    )


# --- repositories ----------------------------------------------------------------------------


@query(twin(
    f"""select least(100, count(*)) as n_rows, true as among_all
        from (select *, {twins.REASON} as reject_reason from contents) j where reject_reason is null""",
    "index_rows", "contents", contents=_CONTENTS,
))
def sampled_records(t: Tables) -> DataFrame:
    """A cap on the dataset records: so many rows, all of them among the records."""
    records = blobs.collect_dataset(t.index(), t.blob_store()).select("repo_name", "path")
    sample = blobs.collect_dataset(t.index(), t.blob_store(), max_samples=100)
    known = records.distinct().withColumn("known", F.lit(True))
    marked = sample.join(known, ["repo_name", "path"], "left")
    return marked.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.every(F.coalesce("known", F.lit(False))), F.lit(True)).alias("among_all"),
    )


@query(twin("select repo_name, rule from found", "found"))
def repo_rules(t: Tables) -> DataFrame:
    return repos.search_hits(t.repos()).select("repo_name", "rule")


@query(twin("select repo_name, rule, stars from first_hits", "first_hits"))
def repo_first_seen(t: Tables) -> DataFrame:
    return repos.first_seen(repos.search_hits(t.repos())).select("repo_name", "rule", "stars")


_CAPPED = f"select * from first_hits order by rule, stars desc, repo_name limit {REPO_CAP}"
_SHARE = """(tsql_bytes + sql_bytes) / (case when tsql_bytes + sql_bytes + other_bytes = 0 then 1
            else tsql_bytes + sql_bytes + other_bytes end)"""


@query(twin("select repo_name, rule, stars from capped", "first_hits", "capped", capped=_CAPPED))
def repo_cap(t: Tables) -> DataFrame:
    return repos.cap_repos(repos.first_hits(t.repos()), REPO_CAP).select("repo_name", "rule", "stars")


@query(twin(f"select repo_name, round({_SHARE}, 9) as share, {_SHARE} >= 0.2 as enough from repos", "repos"))
def repo_sql_share(t: Tables) -> DataFrame:
    share = repos.sql_share()
    return t.repos().select(
        "repo_name", F.round(share, 9).alias("share"), (share >= rules.MIN_SQL_SHARE).alias("enough")
    )


@query(twin(f"select repo_name from repos where {_SHARE} >= 0.2 and has_readme", "repos"))
def repo_gates(t: Tables) -> DataFrame:
    return repos.with_readme(repos.with_sql_share(t.repos())).select("repo_name")


@query(twin("select repo_name from repos where root_kind in (0, 1, 2)", "repos"))
def repo_project_semi(t: Tables) -> DataFrame:
    return repos.with_project(t.repos(), t.repo_files()).select("repo_name")


_LISTED = f"""
    select repo_name, path from (
      select repo_name, path, row_number() over (partition by repo_name order by path) as no
      from repo_files where entry_type = 'blob' and {twins.IS_SQL}) n where no <= {FILE_CAP}"""


@query(twin("select * from listed", "repo_files", "listed", listed=_LISTED))
def files_per_repo_cap(t: Tables) -> DataFrame:
    return repos.listed_files(t.repo_files(), FILE_CAP)


_REPO_RECORDS = f"""
    select f.path, f.repo_name, f.content, c.stars, coalesce(c.license, 'unknown') as license,
           c.root_kind, c.has_readme
    from first_hits c join repo_files f on f.repo_name = c.repo_name
    where f.entry_type = 'blob' and {twins.IS_SQL} and {_SHARE} >= 0.2"""


@query(twin(
    f"""select path, repo_name, stars, license, {twins.MODERN} as modern_tsql, {twins.TAGS} as tags,
               'github-scraped' as source, md5(content) as digest
        from (select *, {twins.REASON} as reject_reason from records) j where reject_reason is null""",
    "repo_files", "first_hits", "records", records=_REPO_RECORDS,
))
def repo_records(t: Tables) -> DataFrame:
    records = repos.collect_repo_files(t.repos(), t.repo_files())
    return records.select(
        "path", "repo_name", "stars", "license", "modern_tsql",
        listed("tsql_features").alias("tags"), "source", F.md5("content").alias("digest"),
    )


@query(twin(
    f"""select path, repo_name, md5(content) as digest
        from (select *, {twins.REASON} as reject_reason from records) j
        where reject_reason is null and has_readme and root_kind in (0, 1, 2) and {twins.MODERN}""",
    "repo_files", "first_hits", "records", records=_REPO_RECORDS,
))
def repo_records_strict(t: Tables) -> DataFrame:
    records = repos.collect_repo_files(
        t.repos(), t.repo_files(),
        require_readme=True, require_project=True, only_modern=True,
    )
    return records.select("path", "repo_name", F.md5("content").alias("digest"))


@query(twin(
    f"""select (select count(distinct repo_name) from first_hits) as n_repos,
               (select count(*) from (select *, {twins.REASON} as reject_reason from records) j
                where reject_reason is null) as n_files""",
    "repo_files", "first_hits", "records", records=_REPO_RECORDS,
))
def collection_totals(t: Tables) -> DataFrame:
    visited = repos.first_hits(t.repos())
    records = repos.collect_repo_files(t.repos(), t.repo_files())
    return report.collection_totals(visited, records)


@query(twin(
    f"""select path, repo_name, license_name as license, size, cast(null as bigint) as stars,
               cast(null as boolean) as modern_tsql, {twins.TAGS} as tags, 'the-stack-v2-dedup' as source
        from (select *, {twins.REASON} as reject_reason from contents) j where reject_reason is null
        union all
        select path, repo_name, license, null, stars, {twins.MODERN}, {twins.TAGS}, 'github-scraped'
        from (select *, {twins.REASON} as reject_reason from records) j where reject_reason is null""",
    "index_rows", "contents", "repo_files", "first_hits", "records",
    contents=_CONTENTS, records=_REPO_RECORDS,
))
def corpus_union(t: Tables) -> DataFrame:
    both = corpus.corpus(
        blobs.collect_dataset(t.index(), t.blob_store()),
        repos.collect_repo_files(t.repos(), t.repo_files()),
    )
    return both.select(
        "path", "repo_name", listed("license").alias("license"), "size", "stars", "modern_tsql",
        listed("tsql_features").alias("tags"), "source",
    )


# --- ranking, chunks, prompts ----------------------------------------------------------------


@query(twin(
    f"""select row_number() over (order by {twins.RANK}) as "rank", file_id, feature_score, n_stars
        from corpus""",
    "corpus",
))
def ranked_files(t: Tables) -> DataFrame:
    numbered = ranking.numbered_ranks(t.corpus_records())
    return numbered.select("rank", "file_id", "feature_score", "n_stars")


_ALL_FILES = {"corpus": "select file_id, content from sql_files"}


@query(twin(
    """select file_id, cast(unnest(generate_series(1, len(parts))) as int) as chunk_no,
              unnest(parts) as chunk from batches where len(parts) > 0""",
    "sql_files", "batches", **_ALL_FILES,
))
def go_chunks(t: Tables) -> DataFrame:
    chunks = F.posexplode(chunking.batch_chunks("content")).alias("no", "chunk")
    return t.sql_files().select("file_id", chunks).select(
        "file_id", (F.col("no") + 1).alias("chunk_no"), "chunk"
    )


@query(twin("select file_id, chunk_no, chunk from objects", "sql_files", "objects", **_ALL_FILES))
def object_chunks(t: Tables) -> DataFrame:
    no_batches = F.size(chunking.batch_chunks("content")) == 0
    chunks = F.posexplode(chunking.object_chunks("content")).alias("no", "chunk")
    return t.sql_files().where(no_batches).select("file_id", chunks).select(
        "file_id", (F.col("no") + 1).alias("chunk_no"), "chunk"
    )


@query(twin("select file_id, chunk_no, md5(chunk) as digest from chunks", "sql_files", "chunks", **_ALL_FILES))
def all_chunks(t: Tables) -> DataFrame:
    chunks = F.posexplode(chunking.extract_chunks("content")).alias("no", "chunk")
    return t.sql_files().select("file_id", chunks).select(
        "file_id", (F.col("no") + 1).alias("chunk_no"), F.md5("chunk").alias("digest")
    )


@query(twin(
    f"""select repo_name, path, chunk_no, cast(length(chunk) as int) as n_chars
        from chunks c join corpus f on f.file_id = c.file_id
        where chunk_no <= 1 and length(chunk) >= {rules.MIN_SENT_CHUNK}""",
    "chunks",
))
def chunk_cap_then_length(t: Tables) -> DataFrame:
    chunks = prompts.sendable(prompts.file_chunks(t.corpus_records(), max_chunks=1))
    return chunks.select("repo_name", "path", "chunk_no", F.length("chunk").alias("n_chars"))


@query(twin(
    """select prompt_id, repo_name, path, chunk_no, is_modern, is_repo, feature_score, n_stars,
              md5(prompt) as prompt_digest from prompts""",
    "prompts",
))
def prompt_table(t: Tables) -> DataFrame:
    return prompts.prompt_table(t.corpus_records()).select(
        "prompt_id", "repo_name", "path", "chunk_no", "is_modern", "is_repo", "feature_score",
        "n_stars", F.md5("prompt").alias("prompt_digest"),
    )


# --- answers and pairs -----------------------------------------------------------------------


@query(twin("select distinct prompt_id, instruction, code from outcomes where outcome = 'accepted'", "outcomes"))
def parse_answers(t: Tables) -> DataFrame:
    parsed = t.responses().select("prompt_id", answers.parse_answer("response_text").alias("p"))
    return parsed.where("p is not null").select("prompt_id", "p.instruction", "p.code")


def _outcomes(t: Tables) -> DataFrame:
    return prompts.with_outcome(prompts.with_answers(t.prompts(), t.responses()))


def _written_outcomes(t: Tables) -> DataFrame:
    """The outcomes for cuts and sorts, which pass over them several times: joined and parsed once."""
    return t.stored("outcomes", lambda: _outcomes(t))


@query(twin("select repo_name, path, chunk_no, outcome from outcomes", "outcomes"))
def answer_outcomes(t: Tables) -> DataFrame:
    return _outcomes(t).select("repo_name", "path", "chunk_no", "outcome")


@query(twin(
    f"""select outcome, count(*) as n_chunks from (
          select outcome from outcomes union all
          select 'short_chunk' from chunks
          where length(chunk) < {rules.MIN_SENT_CHUNK}) o
        group by outcome""",
    "outcomes",
))
def generation_totals(t: Tables) -> DataFrame:
    return report.generation_totals(prompts.file_chunks(t.corpus_records()), _outcomes(t))


_TOP = f"""select * from outcomes where outcome = 'accepted'
           order by {twins.RANK}, chunk_no limit {PAIR_CAP}"""


@query(twin(
    """select instruction, code, path as source_path, repo_name as source_repo, source,
              coalesce(modern_tsql, false) as modern_tsql, tags as tsql_features from top""",
    "outcomes", "top", top=_TOP,
))
def top_pairs(t: Tables) -> DataFrame:
    pairs = prompts.top_pairs(_written_outcomes(t), PAIR_CAP)
    return pairs.drop("prompt_id", "chunk_no").withColumn("tsql_features", listed("tsql_features"))


_TOP_20 = _TOP.replace(f"limit {PAIR_CAP}", "limit 20")


@query(twin(
    "select prompt_id, path as source_path, repo_name as source_repo, instruction from top",
    "outcomes", "top", top=_TOP_20,
))
def resumed_pairs(t: Tables) -> DataFrame:
    """The first 10 pairs written, then the first 20 into the same folder: none lies there twice."""
    path = new_table_path(t.spark, "resumed")
    for n in (10, 20):
        sinks.write_pairs(prompts.top_pairs(_written_outcomes(t), n), path)
    raw = t.spark.read.json(f"{path}/raw")
    return raw.select("prompt_id", "source_path", "source_repo", "instruction")


class _Outage(Exception):
    """A writer that fails half way, in a trial."""


@query(twin(
    f"""select form, prompt_id, path as source_path, chunk_no, n_copies
        from (select distinct prompt_id, path, chunk_no, 1 as n_copies, instruction, code from outcomes where outcome = 'accepted') p
        cross join (select unnest(['alpaca', 'chatml', 'raw']) as form) f""",
    "outcomes",
))
def recovered_pairs(t: Tables) -> DataFrame:
    """Half of the pairs written; all of them, failing after the raw output; then all of them again.

    Each form must hold each pair once. Forms without a key are told apart by their texts.
    """
    path = new_table_path(t.spark, "recovered")
    pairs = t.stored("all_pairs", lambda: prompts.top_pairs(_written_outcomes(t)))
    sinks.write_pairs(pairs.where(F.pmod(F.xxhash64("prompt_id"), F.lit(2)) == 0), path)

    def failing(rows: DataFrame, folder: str) -> None:
        if not folder.endswith("/raw"):
            raise _Outage(folder)
        sinks.write_shards(rows, folder)

    try:
        commits.commit(path, sinks.pair_tables(pairs), failing)
    except _Outage:
        sinks.write_pairs(pairs, path)
    asked = pairs.select("prompt_id", "source_path", "chunk_no", "instruction", F.col("code"))
    text = F.sha2(F.concat_ws("\u0000", "instruction", *chat.alpaca_columns("instruction", "code")[2:]), 256)
    asked = asked.withColumn("digest", text)
    n_asked = asked.groupBy("digest").agg(F.count(F.lit(1)).alias("n_asked"))
    counted = []
    for form, schema, instruction, output in (
        ("raw", "instruction string, code string", F.col("instruction"), None),
        ("alpaca", "instruction string, output string", F.col("instruction"), F.col("output")),
        ("chatml", "messages array<struct<role: string, content: string>>",
         F.col("messages")[0]["content"], F.col("messages")[1]["content"]),
    ):
        rows = commits.read(t.spark, path, form, schema)
        output = chat.alpaca_columns("instruction", "code")[2] if output is None else output
        digest = F.sha2(F.concat_ws("\u0000", instruction, output), 256).alias("digest")
        counted.append(rows.select(F.lit(form).alias("form"), digest))
    found = reduce(DataFrame.unionByName, counted).groupBy("form", "digest").agg(F.count(F.lit(1)).alias("n_found"))
    copies = (F.col("n_found") / F.col("n_asked")).cast("int").alias("n_copies")
    met = found.join(n_asked, "digest").select("form", "digest", copies)
    return met.join(asked, "digest").select("form", "prompt_id", "source_path", "chunk_no", "n_copies")


@query(twin(
    """select repo_name, path, chunk_no, case when outcome = 'missing' then 'error' else outcome end as outcome
       from outcomes""",
    "outcomes",
))
def retried_answers(t: Tables) -> DataFrame:
    """Every call fails at first; the second attempts bring the answers that there are."""
    outage = t.prompts().select("prompt_id").distinct().select(
        "prompt_id", F.lit(None).cast("string").alias("response_text"),
        F.lit("outage").alias("error"), F.lit(1).alias("attempt"),
    )
    second = t.responses().withColumn("attempt", F.lit(2))
    answers = outage.unionByName(second.select(*outage.columns))
    outcomes = prompts.with_outcome(prompts.with_answers(t.prompts(), prompts.latest(answers)))
    return outcomes.select("repo_name", "path", "chunk_no", "outcome")


@query(twin(
    """select repo_name, path, chunk_no from prompts
       where prompt_id not in (select prompt_id from responses where error is null)""",
    "responses",
))
def resume_anti(t: Tables) -> DataFrame:
    return prompts.pending(t.prompts(), t.responses()).select("repo_name", "path", "chunk_no")


def _pairs(t: Tables) -> DataFrame:
    return prompts.accepted(_outcomes(t)).select(*prompts.pair_columns())


_FENCED = "concat('```tsql', chr(10), code, chr(10), '```')"
_PAIRS = "select * from outcomes where outcome = 'accepted'"


@query(twin(f"select instruction, '' as input, {_FENCED} as output from ({_PAIRS}) p", "outcomes"))
def alpaca_rows(t: Tables) -> DataFrame:
    return sinks.as_alpaca(_pairs(t))


@query(twin(
    f"""select unnest(['user', 'assistant']) as role, unnest([instruction, {_FENCED}]) as content
        from ({_PAIRS}) p""",
    "outcomes",
))
def chatml_messages(t: Tables) -> DataFrame:
    return sinks.as_chat(_pairs(t)).select(F.explode("messages").alias("m")).select("m.*")


@query(twin(
    f"""select concat('<|im_start|>user', chr(10), instruction, '<|im_end|>', chr(10),
                      '<|im_start|>assistant', chr(10), {_FENCED}, '<|im_end|>', chr(10),
                      '<|im_start|>assistant', chr(10)) as "text" from ({_PAIRS}) p""",
    "outcomes",
))
def train_text(t: Tables) -> DataFrame:
    return sinks.as_train_text(sinks.as_chat(_pairs(t)))


@query(
    """select conv_id, turn,
              case when role in ('user', 'assistant')
                   then concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)) else '' end as turn_text
       from conversations
       union all
       select conv_id, max(turn) + 1, concat('<|im_start|>assistant', chr(10))
       from conversations group by conv_id"""
)
def conversation_turns(t: Tables) -> DataFrame:
    """Chat text of stored conversations, a row per turn: joined in order they give the text.

    A conversation may be of any length, so its turns are not gathered into one row.
    """
    turns = t("conversations")
    closed = turns.select("conv_id", "turn", chat.turn_text("role", "text").alias("turn_text"))
    ends = turns.groupBy("conv_id").agg((F.max("turn") + 1).alias("turn"))
    return closed.unionByName(ends.withColumn("turn_text", chat.open_turn()))


@query(
    """select conv_id, turn,
              concat(case when role in ('user', 'assistant')
                          then concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)) else '' end,
                     '<|im_start|>assistant', chr(10)) as "text"
       from conversations"""
)
def chatml_text(t: Tables) -> DataFrame:
    """Chat text of one-message lists, one per stored turn, system turns included."""
    messages = F.array(F.struct("role", F.col("text").alias("content"))).alias("messages")
    return sinks.as_train_text(t("conversations").select("conv_id", "turn", messages))


@query(twin(
    """select distinct prompt_id,
              case when length(prompt) % 2 = 0 then cast(length(prompt) as string) end as response_text,
              case when length(prompt) % 2 = 1 then 'ValueError: odd' end as error, 1 as attempt from prompts""",
    "prompts",
))
def generated_answers(t: Tables) -> DataFrame:
    """Each distinct prompt asked once inside the tasks, here of a stand-in for the model."""

    def answer(prompt: str) -> str:
        if len(prompt) % 2:
            raise ValueError("odd")
        return str(len(prompt))

    return prompts.generate(prompts.distinct_prompts(t.prompts()), answer)


# --- the caller's own code -------------------------------------------------------------------


@query(twin("select file_id from sql_files where len(string_split(content, 'SELECT')) > 2", "sql_files"))
def user_predicate(t: Tables) -> DataFrame:
    """A row test in plain Python."""
    return t.sql_files().where(keep_if(lambda texts: texts.str.count("SELECT") > 1, "content")).select("file_id")


@query(twin("select file_id, md5(concat(path, ':', content)) as digest from sql_files", "sql_files"))
def user_batches(t: Tables) -> DataFrame:
    """A map over batches in pandas."""
    joined = map_batches(
        t.sql_files().select("file_id", "path", "content"),
        lambda b: pd.DataFrame({"file_id": b["file_id"], "both": b["path"] + ":" + b["content"]}),
        "file_id bigint, both string",
    )
    return joined.select("file_id", F.md5("both").alias("digest"))


# --- files of lines --------------------------------------------------------------------------


@query(twin(
    """select file_id, (row_number() over (partition by source order by repo_name, path, file_id) - 1) // 1000 as part
       from sql_files""",
    "sql_files",
))
def shard_assignment(t: Tables) -> DataFrame:
    files = t.sql_files().select("source", "repo_name", "path", "file_id")
    parts = assign_parts(files, 1000, ["source"], ["repo_name", "path", "file_id"])
    return parts.select("file_id", "part")


_REPO_SHARDS = """
    with recursive sizes as (
      select repo_name, count(*) as n, row_number() over (order by repo_name) as i from sql_files group by repo_name),
    walk as (
      select i, repo_name, n, n as filled, 0 as shard from sizes where i = 1
      union all
      select s.i, s.repo_name, s.n, case when w.filled >= 700 then s.n else w.filled + s.n end,
             case when w.filled >= 700 then w.shard + 1 else w.shard end
      from walk w join sizes s on s.i = w.i + 1)
    select cast(shard as bigint) as shard, count(*) as n_repos, cast(sum(n) as bigint) as n_rows,
           min(repo_name) as first_repo, max(repo_name) as last_repo from walk group by shard"""


@query(twin(f"select * from ({_REPO_SHARDS}) s", "sql_files"))
def repo_shards(t: Tables) -> DataFrame:
    """Shards of 700 rows or more that begin and end between repositories."""
    files = t.sql_files().select("repo_name", "file_id")
    return pack_groups(files, "repo_name", 700).groupBy("shard").agg(
        F.count_distinct("repo_name").alias("n_repos"), F.count(F.lit(1)).alias("n_rows"),
        F.min("repo_name").alias("first_repo"), F.max("repo_name").alias("last_repo"),
    )


@query(twin(
    """select 'shard_' || lpad(cast(part as varchar), 4, '0') || '.jsonl' as name, count(*) as n_lines,
              cast(sum(file_id) as bigint) as ids
       from (select file_id, (row_number() over (order by repo_name, path, file_id) - 1) // 400 as part from sql_files) p
       group by part""",
    "sql_files",
))
def named_shards(t: Tables) -> DataFrame:
    """Files written as shards of exactly 400 with names by number, and read back by name."""
    files = t.sql_files().select("file_id", "repo_name", "path")
    placed = assign_parts(files, 400, [], ["repo_name", "path", "file_id"])
    path = new_table_path(t.spark, "named")
    shards.write_numbered(placed, path, "part", ["repo_name", "path", "file_id"])
    lines = t.spark.read.text(path).select(
        F.col("_metadata.file_name").alias("name"), F.get_json_object("value", "$.file_id").cast("long").alias("id")
    )
    return lines.groupBy("name").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("id").alias("ids"))


def _json_lines(t: Tables) -> DataFrame:
    return t.sql(twins.fixtures.JSON_LINES, events=spread(t("events").select("event_id", "props")))


@query(twin("select event_id, event_id % 10 not in (0, 1, 3, 4, 5) as valid from json_lines", "json_lines"))
def jsonl_validity(t: Tables) -> DataFrame:
    return _json_lines(t).select("event_id", jsonl.is_json("value").alias("valid"))


@query(twin("""select trim("value") as "value" from json_lines where event_id % 10 not in (0, 1, 3, 4, 5)""",
            "json_lines"))
def resplit_lines(t: Tables) -> DataFrame:
    """Line files with faults, split again into parts of valid lines, and read back."""
    source, parts = new_table_path(t.spark, "lines"), new_table_path(t.spark, "parts")
    _json_lines(t).select("value").write.text(source)
    jsonl.resplit(t.spark, source, parts, rows_per_part=700, glob="*.txt")
    return t.spark.read.text(parts).select("value")


def _rename_only_file(t: Tables, folder: str, to: str) -> None:
    hadoop = t.spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(f"{folder}/part-*")
    store = files.getFileSystem(t.spark._jsc.hadoopConfiguration())
    store.rename(store.globStatus(files)[0].getPath(), hadoop.Path(to))


@query(twin(
    """select case when event_id % 2 = 0 then 'lines.json' else 'lines.jsonl' end as source,
              trim("value") as "value", count(*) over (partition by event_id % 2 order by event_id) as line,
              (count(*) over (partition by event_id % 2 order by event_id) - 1) // 700 as part
       from json_lines where event_id % 10 not in (0, 1, 3, 4, 5)""",
    "json_lines",
))
def resplit_parts(t: Tables) -> DataFrame:
    """Two files that share a stem: each keeps its own lines, in order, in its own parts."""
    folder = new_table_path(t.spark, "stems")
    for rest, suffix in ((0, "json"), (1, "jsonl")):
        lines = _json_lines(t).where(F.col("event_id") % 2 == rest)
        file = lines.repartition(1).sortWithinPartitions("event_id").select("value")
        file.write.text(f"{folder}/{suffix}")
        _rename_only_file(t, f"{folder}/{suffix}", f"{folder}/lines.{suffix}")
    return jsonl.numbered_lines(t.spark, folder, 700, "lines.{json,jsonl}")


@query(twin(
    f"""select concat('user: ', instruction, chr(10), 'assistant: ', {_FENCED}) as chat
        from ({_PAIRS}) p""",
    "outcomes",
))
def chat_reader(t: Tables) -> DataFrame:
    """Message lists written as JSON lines and read back, in order and in pairs."""
    path = new_table_path(t.spark, "chats")
    sinks.write_shards(sinks.as_chat(_pairs(t)), path, rules.REPO_SHARD_ROWS)
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return jsonl.read_chat(t.spark, path).select(F.array_join(lines, "\n").alias("chat"))


@query(twin(f"select count(*) as n_rows from ({_PAIRS}) p", "outcomes"))
def written_pairs(t: Tables) -> DataFrame:
    """Write the pairs in all forms and count what lies there."""
    path = new_table_path(t.spark, "pairs")
    sinks.write_pairs(_pairs(t), path)
    return sinks.row_count(t.spark.read.json(f"{path}/raw"))


@query(twin("select file_id, tags as tags, md5(content) as digest from corpus", "corpus"))
def jsonl_round_trip(t: Tables) -> DataFrame:
    """Corpus records written as shards and read back through the line reader."""
    path = new_table_path(t.spark, "corpus")
    records = t.corpus_records().withColumn("size", F.col("file_id"))
    sinks.write_shards(records.drop("file_id", "tpl"), path)
    back = jsonl.read_corpus(t.spark, [path], "*.json")
    return back.select(
        F.col("size").alias("file_id"), listed("tsql_features").alias("tags"),
        F.md5("content").alias("digest"),
    )


# --- streams ---------------------------------------------------------------------------------


def _file_stream(t: Tables) -> DataFrame:
    """The SQL files as a stream of the files that hold them."""
    files = t.sql_files()
    return t.spark.readStream.schema(files.schema).parquet(t.stored_path("sql_files"))


@query(twin(
    f"""select path, repo_name, {twins.TAGS} as tags, md5(content) as digest
        from judged where reject_reason is null""",
    "judged",
))
def stream_collect(t: Tables) -> DataFrame:
    files = _file_stream(t).select(
        "content", "path", "repo_name",
        F.array().cast("array<string>").alias("detected_licenses"),
        F.length("content").cast("bigint").alias("size"),
    )
    out, done = new_table_path(t.spark, "stream-out"), new_table_path(t.spark, "stream-done")
    records = collect.stream_files(files, tasks_for(t.sql_files()))
    collect.write_stream(records, out, done).awaitTermination()
    back = jsonl.read_corpus(t.spark, [out], "*.json")
    return back.select(
        "path", "repo_name", listed("tsql_features").alias("tags"), F.md5("content").alias("digest")
    )


@query(twin("select distinct repo_name from sql_files", "sql_files"))
def stream_first_seen(t: Tables) -> DataFrame:
    out, done = new_table_path(t.spark, "names-out"), new_table_path(t.spark, "names-done")
    collect.write_stream(collect.first_seen_names(_file_stream(t)), out, done).awaitTermination()
    return t.spark.read.schema("repo_name string").json(out)


@query(twin(f"select instruction, '' as input, {_FENCED} as output from ({_PAIRS}) p", "outcomes"))
def stream_pairs(t: Tables) -> DataFrame:
    """Accepted pairs as a stream into all three outputs; the Alpaca one read back."""
    pairs = t.stored("pairs", lambda: _pairs(t))
    stream = t.spark.readStream.schema(pairs.schema).parquet(t.stored_path("pairs"))
    out, done = new_table_path(t.spark, "pairs-out"), new_table_path(t.spark, "pairs-done")
    collect.write_pair_stream(stream, out, done).awaitTermination()
    back = t.spark.read.schema(sinks.as_alpaca(pairs).schema).json(f"{out}/alpaca")
    return back.select("instruction", "input", "output")


@query(twin(
    f"""select path, repo_name, {twins.TAGS} as tags, md5(content) as digest
        from (select *, {twins.REASON} as reject_reason from contents) j where reject_reason is null""",
    "index_rows", "contents", contents=_CONTENTS,
))
def stream_dataset_records(t: Tables) -> DataFrame:
    """The index as a stream against the bucketed blobs, rows of the much-copied one set apart."""
    t.index()
    stream = blobs.stream_index(t.spark, t.stored_path("index"))
    out, done = new_table_path(t.spark, "records-out"), new_table_path(t.spark, "records-done")
    collect.write_dataset_stream(stream, t.blob_store(), out, done, rows_per_split=100).awaitTermination()
    back = jsonl.read_corpus(t.spark, [f"{out}/records"], "*.json")
    return back.select(
        "path", "repo_name", listed("tsql_features").alias("tags"), F.md5("content").alias("digest")
    )


@query(twin("select file_id from sql_files", "sql_files"))
def stream_restart(t: Tables) -> DataFrame:
    """Half of the files, then all of them, with one checkpoint: each file's rows arrive once."""
    source, out = new_table_path(t.spark, "growing"), new_table_path(t.spark, "restart-out")
    done = new_table_path(t.spark, "restart-done")
    files = t.sql_files().select("file_id")
    for rest in (0, 1):
        files.where(F.col("file_id") % 2 == rest).write.mode("append").parquet(source)
        stream = t.spark.readStream.schema(files.schema).parquet(source)
        collect.write_stream(stream, out, done).awaitTermination()
    return t.spark.read.schema("file_id long").json(out)


# --- business questions ----------------------------------------------------------------------


@query(twin(
    """select c_custkey, c_name from customer where c_custkey not in (
         select o_custkey from orders, now_is where o_orderdate >= now - interval 90 day)""",
    "now_is",
))
def v1_lapsed_customers(t: Tables) -> DataFrame:
    return gold.lapsed_customers(t("customer"), t("orders"))


@query(twin(
    """select p_partkey, p_name,
              cast(sum(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(18,2)))) as double) as revenue
       from lineitem join orders on l_orderkey = o_orderkey join part on p_partkey = l_partkey, now_is
       where o_orderdate >= date_trunc('quarter', now) - interval 3 month
         and o_orderdate < date_trunc('quarter', now)
       group by p_partkey, p_name order by revenue desc, p_partkey limit 10""",
    "now_is",
))
def v2_top_products(t: Tables) -> DataFrame:
    return gold.top_products(t("lineitem"), t("orders"), t("part"))


@query(
    """select n_name, s_name, round(sum(cast(s_acctbal as decimal(18,2))) over w::double
              / count(s_acctbal) over w, 4) as mean_acctbal
       from supplier join nation on s_nationkey = n_nationkey window w as (partition by s_nationkey)"""
)
def v3_members_with_mean(t: Tables) -> DataFrame:
    return gold.members_with_group_mean(t("supplier"), t("nation"))


@query(twin(
    """select o_orderkey, o_custkey, o_totalprice from orders, now_is
       where o_orderdate >= date_trunc('month', now) - interval 1 month
         and o_orderdate < date_trunc('month', now) and o_orderstatus = 'O'""",
    "now_is",
))
def v4_open_orders(t: Tables) -> DataFrame:
    return gold.open_orders_last_month(t("orders"))


@query(twin(
    """select "month", cast(sales as double) as sales,
              cast(sum(sales) over (order by "month") as double) as running_total from (
         select cast(month(o_orderdate) as int) as "month", sum(cast(o_totalprice as decimal(18,2))) as sales
         from orders, now_is where o_orderdate >= date_trunc('year', now) group by 1) m""",
    "now_is",
))
def v5_running_total(t: Tables) -> DataFrame:
    return gold.running_total_this_year(t("orders"))


@query(
    """select sha256(text) as digest, count(*) as n_rows, min(doc_id) as first_key
       from documents group by text having count(*) > 1"""
)
def v6_duplicate_values(t: Tables) -> DataFrame:
    return gold.duplicate_values(t("documents"), "text", "doc_id")


@query(
    """select p_type, round(avg(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date))), 6) as mean_days,
              count(*) as n_items
       from lineitem join orders on l_orderkey = o_orderkey join part on p_partkey = l_partkey
       group by p_type"""
)
def v7_days_to_ship(t: Tables) -> DataFrame:
    return gold.days_to_ship(t("lineitem"), t("orders"), t("part"))


@query(twin(
    """select c_custkey, c_name, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as spent
       from orders join customer on c_custkey = o_custkey, now_is
       where o_orderdate >= date_trunc('year', now)
       group by c_custkey, c_name having sum(cast(o_totalprice as decimal(18,2))) > 10000""",
    "now_is",
))
def v8_big_spenders(t: Tables) -> DataFrame:
    return gold.big_spenders(t("customer"), t("orders"))


@query(
    """select o_custkey, o_orderkey, place from (
         select o_custkey, o_orderkey, cast(row_number() over (
           partition by o_custkey order by o_orderdate desc, o_orderkey desc) as int) as place
         from orders) o where place <= 3"""
)
def v9_recent_orders(t: Tables) -> DataFrame:
    return gold.recent_orders(t("orders"))


@query(twin(
    """select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from staged
       union all
       select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
       where c_custkey not in (select c_custkey from staged)""",
    "staged",
))
def v10_upsert(t: Tables) -> DataFrame:
    changes = t.sql(twins.fixtures.STAGED, customer=t("customer"))
    return gold.upsert(t("customer"), changes, "c_custkey")


# --- flagship --------------------------------------------------------------------------------


_SIDES = """
    with a as (select o_custkey from orders where o_orderkey % 3 = 0),
         b as (select o_custkey from orders where o_orderkey % 3 = 1)
    select o_custkey, 'candidate' as side from (select o_custkey from a except all select o_custkey from b) x
    union all
    select o_custkey, 'gold' from (select o_custkey from b except all select o_custkey from a) y"""


@query(_SIDES)
def answer_difference(t: Tables) -> DataFrame:
    """Two answers of many repeated rows, compared as multisets."""
    keys = t("orders").select("o_orderkey", "o_custkey")
    sides = [keys.where(F.col("o_orderkey") % 3 == n).select("o_custkey") for n in (0, 1)]
    return gold.difference(*sides)


def flagship(t: Tables) -> DataFrame:
    """From files to ranked prompts."""
    table = prompts.prompt_table(t.corpus_records())
    return table.select("prompt_id", *ranking.RANK_COLUMNS, "repo_name", "path", "chunk_no", "prompt")
