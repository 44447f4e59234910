"""URL filters: host rules, and for the rest a ratio of two character language models.

One model learns the URLs that the rules accept, the other those that they reject. A character is
predicted from the five before it where these have been seen, mixed with what fewer characters say as
Witten and Bell do, so the order of the model varies with the evidence. A URL is judged by the
difference of the two log-likelihoods for each character, against a threshold that is calibrated on
labelled URLs which neither model has seen.

Counts cover all labelled URLs and grow with them, so they stay in tables: each order is joined with
the one below, and URLs fetch the ratios of their distinct character sequences shard by shard.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import shards
from .common import map_arrow, stored

#: (verdict, host, path); a rule fits its host and all below it, for paths that begin with its own.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Characters (bytes of UTF-8) before the predicted one that a model looks at.
ORDER = 5
#: Bytes that UTF-8 has not, for places before the start and for the end; a character without any
#: evidence has one chance in SYMBOLS.
BEFORE, END, SYMBOLS = 0xFF, 0xFE, 256
#: One labelled URL of so many is kept from the models, for the threshold.
CALIBRATED = 8
#: Bytes of URLs in a shard, and steps of the threshold in nats a character and their greatest number.
SHARD_BYTES, STEPS, MOST_STEPS = 1 << 23, 200, 8000

_A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parsed(pages, rules=RULES):
    """The columns page_id, url, host, path, rule and ruled of `pages`.

    The host is what follows the first `://` up to `/`, `?`, `#` or the end, with small letters for A to
    Z; the path goes on to `?`, `#` or the end. Both are empty for a null URL and one without `://`. Of
    the rules that fit the longest counts, by host and path together, then the longer host. `rule` and
    `ruled`, its verdict, are null without one.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), rest.alias("rest"))
    rows = rows.select(
        "page_id", "url",
        F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), _A_TO_Z, _A_TO_Z.lower()).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    longest = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1])))
    found = []
    for verdict, host, path in longest:
        below = (F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))
        value = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        found.append(F.when(below & F.startswith("path", F.lit(path)), value))
    best = F.coalesce(*found, F.lit(None).cast("struct<rule: string, verdict: string>"))
    return rows.withColumn("_best", best).select(
        "page_id", "url", "host", "path", F.col("_best.rule").alias("rule"),
        F.col("_best.verdict").alias("ruled"),
    )


def sequences(urls, order=ORDER):
    """(owner, sequence): every character of the URLs, an Arrow array, and the end of each, with the
    `order` characters before it, as the bytes of a number; the last character is the lowest byte."""
    lengths = np.array([len(u.as_buffer()) for u in urls], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + order + 1)])
    padded = np.full(starts[-1], BEFORE, np.uint8)
    for at, url in zip(starts[:-1].tolist(), urls, strict=True):
        raw = url.as_buffer()
        padded[at + order : at + order + len(raw)] = np.frombuffer(raw, np.uint8)
    padded[starts[1:] - 1] = END
    owner = np.repeat(np.arange(len(lengths)), lengths + 1)
    first = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    place = np.arange(len(owner)) - first[owner] + starts[:-1][owner]
    code = np.zeros(len(owner), np.int64)
    for i in range(order + 1):
        code = (code << 8) | padded[place + i]
    return owner, code


_LOCAL = (
    "shard long, page_id long, host string, path string, rule string, ruled string, held boolean, "
    "length long, terms array<int>, counts array<int>, names array<long>"
)


def _local_shards(size):
    fields = [f.split(" ")[0] for f in _LOCAL.split(", ")]

    def run(batches):
        base = None

        def seen():
            nonlocal base
            for batch in batches:
                if base is None and len(batch):
                    base = batch["p"][0].as_py() << 32
                yield batch

        for i, rows in enumerate(shards.cut(seen(), "url", size)):
            owner, code = sequences(rows["url"].combine_chunks())
            known, term = np.unique(code, return_inverse=True)
            terms, counts = shards.sparse(owner, term, rows.num_rows, len(known))
            number = pa.array(np.full(rows.num_rows, base + i))
            kept = [rows[n].combine_chunks() for n in ("page_id", "host", "path", "rule", "ruled", "held")]
            lengths = pa.array(np.bincount(owner, minlength=rows.num_rows))
            nothing = pa.nulls(rows.num_rows, pa.list_(pa.int64()))
            out = pa.RecordBatch.from_arrays([number, *kept, lengths, terms, counts, nothing], fields)
            yield out
            listed = pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), pa.array(known))
            empty = [pa.nulls(1, f.type) for f in out.schema][1:-1]
            yield pa.RecordBatch.from_arrays([number.slice(0, 1), *empty, listed], fields)

    return run


def _counted(local):
    """(name, accepted, rejected) for every distinct sequence of the shards: how often it occurs in the
    accepted and in the rejected URLs that the models learn from."""
    learnt = local.where("names IS NULL AND ruled IS NOT NULL AND NOT held")
    cells = learnt.select("shard", "ruled", F.inline(F.arrays_zip("terms", "counts")))
    sums = [
        F.sum(F.when(F.col("ruled") == verdict, F.col("counts")).otherwise(0)).alias(name)
        for verdict, name in (("allow", "accepted"), ("block", "rejected"))
    ]
    # Per shard first, under the short numbers of its terms; every term of a shard has one row then.
    by_shard = cells.groupBy("shard", F.col("terms").alias("place")).agg(*sums)
    named = shards.names(local).join(by_shard, ["shard", "place"], "left")
    return named.groupBy("name").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("accepted", "rejected")]
    )


def ratios(counted, order=ORDER):
    """(name, ratio) for every sequence of `counted`: the log of the chance that its last character has
    after the others in accepted URLs, less that in rejected ones.

    From the shortest context to the longest, a chance is what was counted in the context, mixed with
    the chance in the context without its first character; the share of the latter is the number of
    different characters that followed. A context without evidence changes nothing. A context has at
    most SYMBOLS followers, so no key of these joins and windows is large.
    """
    counted, below = stored(counted, "url-sequences"), None
    kinds = ("accepted", "rejected")
    for k in range(order + 1):
        name = F.col("name").bitwiseAND((1 << 8 * (k + 1)) - 1)
        level = counted.groupBy(name.alias("s")).agg(*[F.sum(n).alias(n) for n in kinds])
        context = Window.partitionBy(F.shiftright("s", 8))
        if below is None:
            level = level.withColumns({f"p_{n}": F.lit(1.0 / SYMBOLS) for n in kinds})
        else:
            shorter = F.col("s").bitwiseAND((1 << 8 * k) - 1)
            level = level.join(below, shorter == F.col("_s")).drop("_s")
        level = level.withColumns({f"all_{n}": F.sum(n).over(context) for n in kinds} | {
            f"new_{n}": F.sum(F.when(F.col(n) > 0, 1).otherwise(0)).over(context) for n in kinds
        })
        mixed = {
            n: F.when(
                F.col(f"all_{n}") > 0,
                (F.col(n) + F.col(f"new_{n}") * F.col(f"p_{n}")) / (F.col(f"all_{n}") + F.col(f"new_{n}")),
            ).otherwise(F.col(f"p_{n}"))
            for n in kinds
        }
        below = stored(
            level.select(F.col("s").alias("_s"), *[p.alias(f"p_{n}") for n, p in mixed.items()]), "url-order"
        )
    return below.select(
        F.col("_s").alias("name"), (F.log("p_accepted") - F.log("p_rejected")).alias("ratio")
    )


def threshold(scored):
    """The least score that is accepted: of the steps that judge the calibration URLs (held, ruled,
    score) best, both verdicts weighing the same, the middle one; 0 unless both verdicts occur."""
    step = F.greatest(F.lit(-MOST_STEPS), F.least(F.lit(MOST_STEPS), F.floor(F.col("score") * STEPS)))
    held = scored.where("held AND ruled IS NOT NULL")
    # At most 2 * MOST_STEPS + 1 steps and two verdicts, however many URLs.
    rows = held.groupBy(step.cast("int").alias("step"), "ruled").agg(F.count("*").alias("n")).collect()
    found = {v: np.zeros(2 * MOST_STEPS + 2) for v in ("allow", "block")}
    for r in rows:
        found[r["ruled"]][r["step"] + MOST_STEPS] = r["n"]
    allow, block = found["allow"], found["block"]
    if not allow.sum() or not block.sum():
        return 0.0
    below = np.concatenate([[0], np.cumsum(block)[:-1]]) / block.sum()
    right = allow[::-1].cumsum()[::-1] / allow.sum() + below
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return float(best[len(best) // 2] - MOST_STEPS) / STEPS


def scored(pages, rules=RULES):
    """The columns of `parsed` but the URL, and `held`, which labelled URLs the models have not seen, and
    `score`, the difference of the log-likelihoods for each character."""
    kept = F.pmod(F.xxhash64("url"), F.lit(CALIBRATED)) == 0
    rows = parsed(pages, rules).withColumns({"held": kept, "p": F.spark_partition_id()})
    local = stored(map_arrow(rows, _local_shards(SHARD_BYTES), _LOCAL), "url-shards")
    known = ratios(_counted(local))
    values = shards.names(local).join(known, "name").select("shard", "place", F.col("ratio").alias("value"))
    weighted = shards.with_values(local, values, "double")
    total = F.aggregate(
        F.zip_with("terms", "counts", lambda r, n: r * n), F.lit(0.0), lambda a, x: a + x
    )
    return weighted.select(
        "page_id", "host", "path", "rule", "ruled", "held", (total / F.col("length")).alias("score")
    )


def judge(pages, rules=RULES):
    """One row per page: page_id, host, path, rule, verdict, score.

    The verdict is that of the rule (see `parsed`); without one it is allow if the score reaches the
    calibrated threshold. Null URLs are empty, and an empty URL is judged by its end alone. Without
    accepted or without rejected URLs the threshold is 0. URLs are read whole, repeated rows are judged
    each and count each, and equal URLs get equal verdicts. Other columns are not read; an empty table
    gives an empty result.
    """
    rows = stored(scored(pages, rules), "url-scores")
    by_model = F.when(F.col("score") >= threshold(rows), "allow").otherwise("block")
    return rows.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score"
    )
