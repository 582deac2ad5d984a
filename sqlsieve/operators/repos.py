"""Choose repositories by the search rules and take the wanted files out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import any_of, path_suffix
from ..session import cut_lineage
from .corpus import kept, modern_only, repo_records
from .numbering import number_rows


def is_sql_path(path: Column | str) -> Column:
    return path_suffix(path).isin(rules.SQL_SUFFIXES)


def matching_rules() -> Column:
    """Numbers, from 1, of the search rules that a repository meets.

    The rules are few and fixed, so they are plain conditions; no join with a rule table.
    """

    def meets(language: str, stars: int, pushed: str, topic: str | None) -> Column:
        hit = (
            (F.col("language") == language)
            & (F.col("stars") > stars)
            & (F.col("pushed_at") > F.lit(pushed).cast("date"))
        )
        return hit if topic is None else hit & F.array_contains("topics", topic)

    return F.array_compact(
        F.array(*[F.when(meets(*r), F.lit(i)) for i, r in enumerate(rules.REPO_RULES, start=1)])
    )


def search_hits(repos: DataFrame) -> DataFrame:
    """One row per repository and rule that finds it, as ``rule``."""
    return repos.withColumn("rule", F.explode(matching_rules()))


def first_seen(hits: DataFrame) -> DataFrame:
    """One row per repository: that of its lowest rule, most stars first.

    Rows that agree in both follow the latest push, then the license, then the row as text, so
    the choice never depends on the order of the input. An aggregate with partial results, so a
    name that repeats often costs its task nothing.
    """
    others = [c for c in hits.columns if c != "repo_name"]
    ties = [-F.unix_date(c) if c == "pushed_at" else F.col(c)
            for c in ("pushed_at", "license") if c in others]
    order = F.struct("rule", -F.col("stars"), *ties, F.to_json(F.struct(*others)))
    first = F.min_by(F.struct(*others), order)
    return hits.groupBy("repo_name").agg(first.alias("_first")).select("repo_name", "_first.*")


def first_hits(repos: DataFrame) -> DataFrame:
    """``first_seen(search_hits(repos))`` without the rows in between."""
    found = repos.withColumn("rule", F.array_min(matching_rules())).where("rule is not null")
    return first_seen(found)


def cap_repos(found: DataFrame, max_repos: int | None = None) -> DataFrame:
    """The first repositories in the order in which the searches visit them; all without a cap.

    Names alone are numbered, in a sort over all tasks, and the rows are joined back.
    """
    if max_repos is None:
        return found
    order = ["rule", F.desc("stars"), "repo_name"]
    placed = number_rows(found.select("repo_name", "rule", "stars"), [], order, "_no")
    first = placed.where(F.col("_no") <= max_repos)
    return found.join(first.select("repo_name"), "repo_name", "left_semi")


def sql_share(languages: Column | str = "languages") -> Column:
    """Share of the SQL languages in a repository's bytes."""
    languages = F.col(languages) if isinstance(languages, str) else languages
    total = F.aggregate(
        F.map_values(languages), F.lit(0).cast("bigint"), lambda acc, n: acc + n
    )
    sql = sum(
        (F.coalesce(F.try_element_at(languages, F.lit(x)), F.lit(0)) for x in rules.SQL_LANGUAGES),
        F.lit(0),
    )
    return sql / F.when(total == 0, 1).otherwise(total)


def with_sql_share(repos: DataFrame, least: float = rules.MIN_SQL_SHARE) -> DataFrame:
    return repos.where(sql_share() >= least)


def with_readme(repos: DataFrame) -> DataFrame:
    return repos.where(F.coalesce("has_readme", F.lit(False)))


def project_repos(repo_files: DataFrame) -> DataFrame:
    """Names of repositories with a database project or test framework at their root."""
    name = F.lower("path")
    project = any_of([name.endswith(e) for e in rules.PROJECT_FILE_ENDINGS]) | name.contains(
        rules.PROJECT_NAME_PART
    )
    at_root = ~F.col("path").contains("/")
    return repo_files.where(at_root & project).select("repo_name").distinct()


def with_project(repos: DataFrame, repo_files: DataFrame) -> DataFrame:
    """Repositories with a project; only names come back from the scan of the files."""
    return repos.join(project_repos(repo_files), "repo_name", "left_semi")


def choose_repos(
    repos: DataFrame,
    repo_files: DataFrame | None = None,
    max_repos: int | None = None,
    require_readme: bool = False,
    require_project: bool = False,
) -> DataFrame:
    """Search, keep first sights, cap if asked to, then gate.

    A repository counts toward the cap when it is seen, before its gates.
    """
    chosen = with_sql_share(cap_repos(first_hits(repos), max_repos))
    if require_readme:
        chosen = with_readme(chosen)
    if require_project:
        chosen = with_project(chosen, repo_files)
    return chosen


def listed_files(files: DataFrame, max_files: int | None = None) -> DataFrame:
    """(repo_name, path) of each repository's SQL files; with a cap the first in path order.

    Reads names only. Under a cap rows are numbered without bringing a repository to one task.
    """
    names = files.where((F.col("entry_type") == "blob") & is_sql_path("path")).select(
        "repo_name", "path"
    )
    if max_files is None:
        return names
    return number_rows(names, ["repo_name"], ["path"], "_no").where(
        F.col("_no") <= max_files
    ).drop("_no")


def repo_files_to_read(
    chosen: DataFrame, repo_files: DataFrame, max_files: int | None = None
) -> DataFrame:
    """Files of the chosen repositories, within the cap if there is one, with the repository's
    own columns. ``(repo_name, path)`` is the key of the file table.

    The cap counts listed paths, before any look at content. Without one, contents meet the list
    of repositories alone; with one, the keys are cut first. Whether the narrow side is broadcast
    is left to its size as measured when it is there.
    """
    columns = [c for c in ("repo_name", "stars", "license") if c in chosen.columns]
    wanted = (F.col("entry_type") == "blob") & is_sql_path("path")
    contents = repo_files.where(wanted).select("repo_name", "path", "content")
    if max_files is not None:
        asked = repo_files.join(chosen.select("repo_name"), "repo_name", "left_semi")
        contents = contents.join(listed_files(asked, max_files), ["repo_name", "path"], "left_semi")
    return contents.join(chosen.select(*columns), "repo_name")


def collect_repo_files(
    repos: DataFrame,
    repo_files: DataFrame,
    max_repos: int | None = None,
    max_files: int | None = None,
    require_readme: bool = False,
    require_project: bool = False,
    only_modern: bool = False,
) -> DataFrame:
    """From repository and file tables to corpus records."""
    chosen = choose_repos(repos, repo_files, max_repos, require_readme, require_project)
    # A narrow list, worked out once; its size is known when the joins are planned.
    chosen = cut_lineage(chosen.select("repo_name", "stars", "license"))
    files = kept(repo_files_to_read(chosen, repo_files, max_files), "stars")
    records = repo_records(files)
    return modern_only(records) if only_modern else records
