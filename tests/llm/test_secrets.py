import hashlib
import random
import re
import uuid

from pyspark.sql import functions as F

from sqlsieve.llm import secrets

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)


def known(text: str) -> list[tuple[int, int, int]]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def listed(spans) -> str:
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def texts() -> list[str]:
    rng = random.Random(3)
    parts = [
        "secret=token: abcdefghij", "PASSWORD = 'x.y=z12345'", "token=ab", "Api_Key: \"q1w2e3r4\"", "apikey=a=b=c=d", "é😀",
        "AKIA" + "Q7" * 9, "AKIAAKIA" + "Z" * 12, "AKIA123", "0123456789abcdef" * 2, "deadbeef", " ", "\n", "token=deadbeefdeadbeefdeadbeef00",
    ]
    return ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 12))) for _ in range(120)]


def test_known_forms(spark):
    rows = list(enumerate([*texts(), " token=abcdef" * 3000, "", None]))
    rows += [rows[0], (None, "password=abcdefg")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets.secret_spans(docs).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for key, text in rows:
        spans = known(text or "")
        got = by_id[key]
        assert [got["n_assign"], got["n_access"], got["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert got["base_sha256"] == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert [s for s in got["spans"].split(",") if s and not s.startswith("random")] == [s for s in listed(spans).split(",") if s]
    assert secrets.secret_spans(docs.limit(0)).count() == 0


def candidates(text: str) -> list[tuple[int, int]]:
    found = []
    for m in re.finditer("[A-Za-z0-9+/_-]{20,}={0,2}", text):
        body, groups = m[0].rstrip("="), {len(g) for g in re.split("[-_]", m[0].rstrip("="))}
        if len(groups) == 1 and max(groups) > 1:
            body = re.sub("[-_]", "", body)
        mixed = re.search("[A-Za-z]", body) and re.search("[0-9]|[a-z][A-Z]", body)
        if mixed and not any(a < m.end() and m.start() < b for a, _, b in known(text)):
            found.append((m.start(), m.end()))
    return found


def mixed_texts() -> list[str]:
    rng = random.Random(17)
    parts = [
        "g7" * 9, "g7" * 10, "Zq" * 10, "x", "9", "/", "-", "_", "+", "=", "==", ".", " ", "\n", "é", "😀", ":", "AKIA" + "Q7" * 8,
        "0a" * 11, "0a" * 12, "token=", "Secret: ", "passwd" + " " * 8 + "=", "password" + " " * 12 + "= ", "api_key\" :'", "abcdef",
    ]
    return ["".join(rng.choice(parts) for _ in range(n)) for n in [*range(1, 25)] * 30 + [4000]]


def test_candidates_lie_outside_known_spans(spark):
    rows = list(enumerate([*mixed_texts(), "", None]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["row"]["doc_id"]: r for r in secrets.searched(docs, [docs["doc_id"]]).collect()}
    for key, text in rows:
        assert [tuple(s) for s in found[key]["known"]] == known(text or "")
        assert [(t["span"]["start"], t["span"]["end"]) for t in found[key]["tokens"]] == candidates(text or ""), text
    assert sum(len(r["tokens"]) for r in found.values()) > 500


def test_texts_are_read_once(spark, tmp_path):
    """What was found in them is written, counted and judged; the result does not go back to the texts."""
    rows = [(i, f"use {k} here") for i, k in enumerate(keys(20, 40))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    assert any(str(tmp_path) in f for f in docs.inputFiles())
    found = secrets.secret_spans(docs)
    assert not any(str(tmp_path) in f for f in found.inputFiles())
    assert found.count() == len(rows)


def keys(n: int, size: int) -> list[str]:
    rng = random.Random(size)
    alphabet = secrets.ALPHABETS["base64"]
    return ["".join(rng.choice(alphabet) for _ in range(size)) for _ in range(n)]


def test_random_tokens_are_found_and_names_are_not(spark):
    random_keys = keys(60, 40)
    names = [f"release_candidate_for_version_{i}_of_the_documentation" for i in range(60)]
    text = [f"use {k} here" for k in random_keys] + [f"open {n} now" for n in names]
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in secrets.secret_spans(docs).collect()}
    assert sum(found[i]["n_random"] for i in range(60)) >= 50
    assert sum(found[i]["n_random"] for i in range(60, 120)) <= 3
    one = next(i for i in range(60) if found[i]["n_random"])
    assert found[one]["spans"] == f"random:4:{4 + len(random_keys[one])}"


LOWER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
FORMS = {
    "base36": LOWER + DIGITS, "base36 upper": LOWER.upper() + DIGITS, "base32": LOWER + "234567",
    "base32 upper": LOWER.upper() + "234567", "letters": LOWER + LOWER.upper(),
    "base62": LOWER + LOWER.upper() + DIGITS, "base64": LOWER + LOWER.upper() + DIGITS + "+/",
    "base64 url": LOWER + LOWER.upper() + DIGITS + "-_", "hex upper": DIGITS + "ABCDEF",
}


def made(rng, form: str, size: int) -> str:
    if form == "uuid":
        return str(uuid.UUID(int=rng.getrandbits(128), version=4))
    if form == "grouped":
        return "-".join("".join(rng.choice(FORMS["base36 upper"]) for _ in range(5)) for _ in range(5))
    return "".join(rng.choice(FORMS[form]) for _ in range(size))


def recall(spark, keys_of: dict, others=()) -> dict:
    """Share of each name's keys that are reported whole, over one table of all keys."""
    rows = [(name, key) for name, found in keys_of.items() for key in found] + [("", o) for o in others]
    table = spark.createDataFrame([(i, f"use {k} here") for i, (_, k) in enumerate(rows)], "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in secrets.secret_spans(table).collect()}
    whole = [(name, found[i] == f"random:4:{4 + len(k)}") for i, (name, k) in enumerate(rows)]
    return {n: sum(w for m, w in whole if m == n) / len(found_keys) for n, found_keys in keys_of.items()}


def test_random_keys_of_each_alphabet_and_length(spark):
    rng = random.Random(11)
    for size in (20, 24, 32, 40, 64):
        keys_of = {form: [made(rng, form, size) for _ in range(150)] for form in FORMS}
        keys_of |= {"uuid": [made(rng, "uuid", 0) for _ in range(150)], "grouped": [made(rng, "grouped", 0) for _ in range(150)]}
        shares = recall(spark, keys_of)
        assert {f: s for f, s in shares.items() if s < 0.93} == {}, size


def test_random_keys_among_others_of_their_length(spark):
    rng = random.Random(12)
    words = ["release", "candidate", "version", "of", "the", "documentation", "final", "draft", "notes", "with"]
    names = ["".join(rng.choice(words) for _ in range(5)) + str(i) for i in range(600)]
    base64 = [made(rng, "base64", 40) for _ in range(600)]
    keys_of = {form: [made(rng, form, 40) for _ in range(60)] for form in FORMS}
    shares = recall(spark, keys_of | {"names": names}, base64)
    assert shares.pop("names") < 0.05
    assert {f: s for f, s in shares.items() if s < 0.85} == {}


def test_false_discovery_rule(spark):
    rng = random.Random(5)
    steps = [rng.randint(0, 3) for _ in range(500)] + [rng.randint(60, 200) for _ in range(80)]
    df = spark.createDataFrame([("base64:5", s) for s in steps], "class string, step int")
    first = secrets.cleared_from(df, 0.05)["base64:5"]
    passing = [
        s for s in set(steps)
        if 10 ** (-s / secrets.STEPS) <= 0.05 * sum(x >= s for x in steps) / len(steps)
    ]
    assert first == min(passing)


def test_redaction(spark):
    rows = [(1, "password=abcdefgh and token=0123456789abcdef01234567 end", "s"), (2, None, "t"), (3, "clean é😀", None), (4, "", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = secrets.redact(docs)
    assert found.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["spans"]) for r in found.collect()}
    assert got == {1: ("[SECRET] and [SECRET] end", "s"), 2: (None, "t"), 3: ("clean é😀", None), 4: ("", "u")}


def test_running_sums(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        row = spark.range(1).select(secrets.running(F.array(*[F.lit(i) for i in range(n)]) if n else F.array().cast("array<int>")).alias("r")).first()
        assert row["r"] == [sum(range(i + 1)) for i in range(n)]
