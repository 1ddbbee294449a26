"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only.

Patterns give candidate values. Their hashes are aggregated over the whole corpus: in how many repositories and
by how many owners does a value stand? What many owners hold is a copied example; what at most ``FEW_OWNERS`` hold
and looks like a live credential is owner-specific. Bare values that no pattern names are added as spans if
they are owner-specific, and either stand as a named credential elsewhere or are as random as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.frames import stored

FEW_OWNERS = 2
# A value that stands more often is joined in slots; others go by their hash alone.
HOT_ROWS = 1000

_VALUE = "A-Za-z0-9+/_.=-"
# Kinds in their order, pattern, least size. The size of an assignment is that of its value, and a match below
# it still takes its place in the text. The others are whole runs, of which the pattern finds only those of the least size.
KINDS = (
    ("assign", rf"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([{_VALUE}]+)""", 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 16),
    ("hex", r"[0-9a-f]{32,}", 32),
)
# The method's own kind: whole runs of value characters with a digit. No position is read twice.
BARE = ("bare", rf"(?<![{_VALUE}])(?=[A-Za-z+/_.=-]*[0-9])[{_VALUE}]{{8,}}", 8)
_BARE = len(KINDS)

LEAST_DISTINCT = 6
# Parts of values that only stand for a credential.
PLACEHOLDER = r"example|sample|dummy|placeholder|changeme|your|test|xxxx|0000|12345|abcdef|password|secret"
# A bare value is as random as a credential: long, of one kind of run, both cases, digits, many characters.
RANDOM_SHAPE, RANDOM_DISTINCT = r"^[A-Za-z0-9+/_=-]{20,}$", 12


def _found(text: Column, number: int, pattern: str) -> Column:
    """All matches of a kind: number, place among them, code points from the match before, match."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    # One gap more than matches: the last has no match.
    pairs = F.arrays_zip(gaps.alias("gap"), whole.alias("match"))
    listed = F.transform(
        pairs, lambda p, i: F.struct(F.lit(number).alias("kind"), i.alias("place"), p["gap"].alias("gap"), p["match"].alias("match"))
    )
    return F.when(text.rlike(pattern), F.filter(listed, lambda p: p["match"].isNotNull())).otherwise(F.array().cast("array<struct<kind:int,place:int,gap:int,match:string>>"))


def _least(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(least) for _, _, least in (*KINDS, BARE)]), kind + 1)


def candidates(docs: DataFrame) -> DataFrame:
    """Spans (uid, owner, repo, kind, start, end, value) of rows (uid, owner, repo, found) whose size suffices."""
    each = docs.select("uid", "owner", "repo", F.explode("found").alias("f")).select("uid", "owner", "repo", "f.*")
    so_far = Window.partitionBy("uid", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("match").cast("long")
    each = each.withColumn("end", F.sum(F.col("gap") + size).over(so_far)).withColumn("start", F.col("end") - size)
    value = F.when(F.col("kind") == 0, F.regexp_extract("match", KINDS[0][1], 1)).otherwise(F.col("match"))
    each = each.select("uid", "owner", "repo", "kind", "start", "end", value.alias("value"))
    return each.where((F.length("value") >= _least(F.col("kind"))) & ((F.col("kind") < _BARE) | F.col("value").rlike("[A-Za-z]")))


def _looks() -> dict[str, Column]:
    """What the characters of a value tell, without marks at its end."""
    value = F.regexp_replace("value", "[.=-]+$", "")
    distinct = F.size(F.array_distinct(F.filter(F.split(value, ""), lambda c: c != "")))
    live = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (distinct >= LEAST_DISTINCT) & ~F.lower(value).rlike(PLACEHOLDER)
    random = value.rlike(RANDOM_SHAPE) & value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9].*[0-9]") & (distinct >= RANDOM_DISTINCT)
    return {"code": F.sha2(value, 256), "live": live, "random": random & ~value.rlike("/.*/.*/")}


def ownership(spans: DataFrame) -> DataFrame:
    """For each candidate hash: n_rows, n_owners, n_repos (of one owner each), named (a pattern names it somewhere).

    Counted in steps that each reduce before they shuffle, so a value in a third of all rows is a few rows a task.
    """
    named = (F.col("kind") < _BARE).cast("int")
    by_repo = spans.groupBy("code", "owner", "repo").agg(F.count("*").alias("n"), F.max(named).alias("named"))
    by_owner = by_repo.groupBy("code", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"), F.max("named").alias("named"))
    return by_owner.groupBy("code").agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.max("named").alias("named")
    )


def _with_ownership(spans: DataFrame, owned: DataFrame) -> DataFrame:
    """Each span with the counts of its value; values of very many spans are dealt into slots."""
    slots = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    facts = F.struct("n_owners", "n_repos", "named")
    hot = owned.where(F.col("n_rows") > HOT_ROWS).select("code", facts.alias("hot"), F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    rare = owned.where(F.col("n_rows") <= HOT_ROWS).select(F.col("code").alias("key"), facts.alias("rare"))
    dealt = spans.withColumn("slot", F.pmod(F.xxhash64("uid", "start"), F.lit(slots)).cast("int")).join(hot, ["code", "slot"], "left")
    # What is settled takes a key of its own that meets nothing, so these rows spread.
    key = F.when(F.col("hot").isNull(), F.col("code")).otherwise(F.concat_ws(":", F.col("uid").cast("string"), F.col("start").cast("string")))
    found = dealt.withColumn("key", key).join(rare, "key", "left").withColumn("facts", F.coalesce("hot", "rare"))
    return found.select(*spans.columns, "facts.*")


def judged(docs: DataFrame) -> DataFrame:
    """Spans (uid, kind, start, end, n_owners, n_repos, verdict) of rows (uid, owner, repo, found): base spans and the method's own."""
    spans = candidates(docs).select("*", *(c.alias(n) for n, c in _looks().items())).drop("value")
    # Bare values that overlap a named span add nothing.
    along = Window.partitionBy("uid").orderBy("start", "kind")
    base = F.col("kind") < _BARE
    before = F.max(F.when(base, F.col("end"))).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(base, F.col("start"))).over(along.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # A bare run that starts where a named span does sorts behind it.
    spans = spans.withColumn("beside", ~base & ((F.coalesce(before, F.lit(-1)) > F.col("start")) | (F.coalesce(after, F.col("end")) < F.col("end"))))
    spans = stored(spans.where(~F.col("beside")).drop("beside"), "secret-spans")
    found = _with_ownership(spans, ownership(spans))
    copied = F.col("n_owners") > FEW_OWNERS
    verdict = F.when(copied, "copied").when(F.col("live"), "live").otherwise("weak")
    found = found.withColumn("verdict", verdict)
    return found.where(base | ((F.col("verdict") == "live") & ((F.col("named") > 0) | F.col("random"))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str | None = "source", repo_col: str | None = None) -> DataFrame:
    """Secrets of every document: id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied.

    Spans are ``kind:start:end`` in code points, by start, then kind; an assignment's span is its whole match.
    ``base_sha256`` digests the spans of the three fixed kinds, ``spans`` lists them and the method's own of
    kind ``bare``. ``n_live`` counts the spans whose value at most ``FEW_OWNERS`` owners hold and that
    looks like a credential, ``n_copied`` those that more owners hold. Without ``repo_col`` each id is a
    repository; without ``owner_col`` all rows have one owner, as rows of a null owner do. Null and empty texts have no spans. Every row
    comes back once, repeated ids and texts included; other columns are left out.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    owner = F.coalesce(F.col(owner_col).cast("string"), F.lit("")) if owner_col else F.lit("")
    repo = F.coalesce(F.col(repo_col or id_col).cast("string"), F.lit(""))
    found = F.concat(*[_found(F.col("text"), number, pattern) for number, (_, pattern, _) in enumerate((*KINDS, BARE))])
    held = docs.select(F.col(id_col).alias("id"), text.alias("text"), owner.alias("owner"), repo.alias("repo"))
    # Row numbers are stored with the rows, so they stay the same for every later reader.
    held = stored(held.select(F.monotonically_increasing_id().alias("uid"), "id", "owner", "repo", found.alias("found")), "secret-candidates")
    names = F.array(*[F.lit(name) for name, _, _ in (*KINDS, BARE)])
    each = judged(held.where(F.size("found") > 0))
    listed = F.array_sort(F.collect_list(F.struct("start", "kind", "end")))
    by_row = each.groupBy("uid").agg(
        *[F.count_if(F.col("kind") == number).alias(f"n_{name}") for number, (name, _, _) in enumerate(KINDS)],
        F.count_if(F.col("verdict") == "live").alias("n_live"),
        F.count_if(F.col("verdict") == "copied").alias("n_copied"),
        listed.alias("listed"),
    )
    joined = held.select("uid", "id").join(by_row, "uid", "left")

    def spelled(spans: Column) -> Column:
        shown = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
        return F.coalesce(F.array_join(shown, ","), F.lit(""))

    count = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    return joined.select(
        F.col("id").alias(id_col),
        *[count(f"n_{name}") for name, _, _ in KINDS],
        F.sha2(spelled(F.filter("listed", lambda s: s["kind"] < _BARE)).cast("binary"), 256).alias("base_sha256"),
        spelled(F.col("listed")).alias("spans"),
        count("n_live"),
        count("n_copied"),
    )
