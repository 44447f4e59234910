"""Secrets in texts, told apart by how many owners hold them.

Only native expressions: patterns give the values, the pieces between them give the places, and
every candidate value is counted over the corpus by distinct repositories and owners. A value that
several owners share, or that is copied through many repositories of one, is an example; one that
stays with few is live-looking. Opaque tokens are too common to report wherever they occur, so they
become spans only if they are live-looking.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import stored, whole_text

# Kind, pattern, group that holds the value, least length of the value, and what a
# text must contain in small letters for the pattern to match at all. Runs of hexadecimal digits
# are matched from their least length on, which gives the same runs.
BASE_KINDS = (
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12, r"password|passwd|secret|token|api_?key",
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, None),
    ("hex", r"[0-9a-f]{16,}", 0, 16, None),
)
OPAQUE = ("opaque", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+", 0, 20, None)
KINDS = tuple(k[0] for k in BASE_KINDS) + (OPAQUE[0],)
#: A value held by this many owners, or in this many repositories, is an example.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 10
PIECE = "struct<kind: int, number: int, gap: int, size: int, digest: binary>"


def _quoted(pattern):
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(number, kind):
    """The matches of a kind in column `text`, in their order: array of PIECE.

    `gap` counts the code points between a match and the one before, `size` its own. The digest of
    the value is null if the value is too short, or is an opaque token without letters or digits.
    """
    _, pattern, group, least, needs = kind
    p = _quoted(pattern)
    wanted = f"length(x['2']) >= {least}"
    if kind is OPAQUE:
        wanted += " AND x['2'] RLIKE '[0-9]' AND x['2'] RLIKE '[A-Za-z]'"
    found = f"""
        transform(
            filter(arrays_zip(split(text, {p}, -1), regexp_extract_all(text, {p}, 0),
                              regexp_extract_all(text, {p}, {group})), x -> x['1'] IS NOT NULL),
            (x, i) -> named_struct(
                'kind', {number}, 'number', i, 'gap', length(x['0']), 'size', length(x['1']),
                'digest', if({wanted}, unhex(sha2(x['2'], 256)), NULL)))"""
    test = f"lower(text) RLIKE {_quoted(needs)}" if needs else f"text RLIKE {p}"
    return F.expr(f"CASE WHEN {test} THEN {found} ELSE cast(array() AS array<{PIECE}>) END")


def pieces(docs, repo="doc_id", owner="source"):
    """One row per document: row, doc_id, repo, owner and the matches of all kinds."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(repo).cast("string").alias("repo"),
        F.col(owner).cast("string").alias("owner"), whole_text().alias("text"),
    ).withColumn("row", F.monotonically_increasing_id())
    found = F.concat(*(matches(i, k).cast(f"array<{PIECE}>") for i, k in enumerate((*BASE_KINDS, OPAQUE))))
    return rows.select("row", "doc_id", "repo", "owner", found.alias("pieces"))


def candidates(found):
    """The candidates of stored `pieces`: row, doc_id, repo, owner, start, kind, end, digest.

    Places count code points, the end is exclusive: running sums over the pieces of a text, in
    time that grows with their number. Opaque tokens that touch a base match are left out; a match
    that begins earlier is found by the greatest end so far, a later one by the least start to come.
    """
    kept = ["row", "doc_id", "repo", "owner"]
    flat = found.where(F.size("pieces") > 0).select(*kept, F.explode("pieces").alias("p")).select(*kept, "p.*")
    so_far = Window.partitionBy("row", "kind").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far).cast("int")
    # One exchange serves all windows, as each text is one row.
    placed = flat.repartition("row").withColumn("end", end)
    placed = placed.where(F.col("digest").isNotNull()).withColumn("start", F.col("end") - F.col("size"))
    base, text = F.col("kind") < len(BASE_KINDS), Window.partitionBy("row")
    before = text.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = text.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    touched = F.coalesce(F.max(F.when(base, F.col("end"))).over(before) > F.col("start"), F.lit(False)) | F.coalesce(
        F.min(F.when(base, F.col("start"))).over(after) < F.col("end"), F.lit(False)
    )
    return placed.withColumn("touched", touched).where(base | ~F.col("touched")).select(
        *kept, "start", "kind", "end", "digest"
    )


def ownership(found):
    """(digest, repos, owners) over all candidates: in how many distinct ones a value occurs.

    A null repository or owner counts as one of its own.
    """
    each = found.select(
        F.coalesce(F.concat(F.lit("="), "repo"), F.lit("")).alias("repo"),
        F.coalesce(F.concat(F.lit("="), "owner"), F.lit("")).alias("owner"),
        "digest",
    )
    return each.groupBy("digest").agg(
        F.count_distinct("repo").alias("repos"), F.count_distinct("owner").alias("owners")
    )


def scan(docs, repo="doc_id", owner="source", example_owners=EXAMPLE_OWNERS, example_repos=EXAMPLE_REPOS):
    """One row per document: doc_id and `spans`, by place and kind, as (start, kind, end, live).

    Base matches are always spans; opaque tokens are if they are live-looking. Null texts are
    empty and have no spans. Repeated rows are scanned each, and share a repository if they share
    its name. Texts of any length are read whole. Spans that begin together stand in the order of
    the kinds. An empty table gives no rows. Other columns are not read.
    """
    rows = stored(pieces(docs, repo, owner), "secret-pieces")
    found = stored(candidates(rows), "secret-candidates")
    owners = stored(ownership(found), "secret-owners").withColumnRenamed("digest", "_digest")
    judged = found.join(owners, F.col("digest") == F.col("_digest"))
    live = (F.col("owners") < example_owners) & (F.col("repos") < example_repos)
    judged = judged.select("row", "doc_id", F.struct("start", "kind", "end", live.alias("live")).alias("s"))
    judged = judged.where((F.col("s.kind") < len(BASE_KINDS)) | F.col("s.live"))
    # Texts without matches keep out of the exchange; those with matches may have none that is shown.
    span = "struct<start: int, kind: int, end: int, live: boolean>"
    matching = rows.where(F.size("pieces") > 0).select("row", "doc_id", F.lit(None).cast(span).alias("s"))
    with_spans = judged.unionByName(matching).groupBy("row", "doc_id").agg(
        F.sort_array(F.collect_list("s")).alias("spans")
    )
    none = rows.where(F.size("pieces") == 0).select("row", "doc_id", F.expr(f"cast(array() AS array<{span}>)").alias("spans"))
    return with_spans.unionByName(none).drop("row")


def listed(spans):
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )))


def digests(scanned):
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example."""
    def count(condition):
        return F.size(F.filter("spans", condition)).cast("long")

    def of_kind(number):
        return count(lambda s: s["kind"] == number)

    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    counts = [of_kind(i).alias(f"n_{k[0]}") for i, k in enumerate(BASE_KINDS)]
    return scanned.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"), count(lambda s: ~s["live"]).alias("n_example"),
    )
