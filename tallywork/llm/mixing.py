"""Temperature mixing of sources, in DataFrame operations only.

A source's share of all tokens is raised to an exponent and normalised: 1 keeps the natural mix, 0 makes all sources equal.
The exponent is found by bisection, in steps that halve or better, so that the mix has a wanted entropy or that no source is
repeated more than a limit allows.  Weights times a token budget are the sources' budgets, and these are realised exactly to
within a document: the passes over a source are permutations by hash, end to end, cut where the budget ends.

Sums along a permutation are made in two levels.  Hash ranges of a few thousand documents are summed first, the ranges' sums
are added up per source, and the running sum within a range starts from there; no task ever holds a source.  Equal rows are one row with a count
there, and keys are hashes of id and text, so rows that share an id, or have none, spread over the ranges.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.shared import fresh, written

#: Words: what lies between ASCII white space.  They stand for tokens in shares and budgets.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one hash range on average.
RANGE_DOCS = 4_096
#: Tokens of a block of the mixed stream.
BLOCK_TOKENS = 1_000_000
_SEGMENTS, _ROUNDS = 64, 9
#: A hash is the first 60 bits of an MD5.
_HASH_BITS = 60


def _hash(*parts: Column | str) -> Column:
    text = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _HASH_BITS // 4), 16, 10).cast("long")


def _mark(text: str) -> Column:
    """60 bits that tell texts of one id apart; a NULL text is an empty one."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")), 1, _HASH_BITS // 4), 16, 10).cast("long")


def _key(seed: str, turn: Column, id: Column, mark: Column) -> Column:
    return _hash(seed, turn.cast("string"), F.coalesce(id.cast("string"), F.lit("")), mark.cast("string"))


def sized(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``doc_id, source, mark, tokens, copies`` of every different row; a NULL source is a source, a NULL text has no tokens."""
    tokens = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    each = docs.select(F.col(id).alias("doc_id"), F.col(source).alias("source"), _mark(text).alias("mark"), tokens.alias("tokens"))
    return each.groupBy("doc_id", "source", "mark", "tokens").agg(F.count("*").alias("copies"))


def source_sizes(sizes: DataFrame) -> DataFrame:
    return sizes.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("docs"))


def _measures(sources: DataFrame, total: int, exponents: list[float]) -> list[tuple[float, float, float]]:
    """``(exponent, entropy, most repeats of the smallest over the largest)`` of each exponent; one row per exponent."""
    share = F.col("tokens") / F.lit(float(total))
    tried = sources.where("tokens > 0").select(share.alias("p"), F.explode(F.array(*[F.lit(x) for x in exponents])).alias("x"))
    power = F.pow("p", F.col("x"))
    rows = tried.groupBy("x").agg(
        F.sum(power).alias("z"), F.sum(power * F.log(power)).alias("s"), F.max(F.pow("p", F.col("x") - 1)).alias("most"), F.min(F.pow("p", F.col("x") - 1)).alias("least"),
    ).collect()
    return sorted((r.x, math.log(r.z) - r.s / r.z, r.most / r.least) for r in rows)


def find_exponent(sources: DataFrame, entropy: float | None = None, repetition: float | None = None) -> float:
    """The exponent in [0, 1] that meets a target; both measures fall as it grows.

    ``entropy`` (nats): the largest exponent whose mix has so much; 0 if none has.  ``repetition``: the smallest exponent under
    which the most repeated source is read at most so many times for one time of the least repeated; 1 if none is below.
    """
    if (entropy is None) == (repetition is None):
        raise ValueError("one target is needed: entropy or repetition")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return 1.0
    low, high = 0.0, 1.0
    ends = _measures(sources, total, [low, high])
    good = (lambda m: m[1] >= entropy) if repetition is None else (lambda m: m[2] > repetition)  # holds below the answer
    if not good(ends[0]):
        return low
    if good(ends[1]):
        return high
    for _ in range(_ROUNDS):
        grid = [low + (high - low) * k / _SEGMENTS for k in range(1, _SEGMENTS)]
        met = [m[0] for m in _measures(sources, total, grid) if good(m)]
        low, high = max(met, default=low), min((x for x in grid if x > max(met, default=low)), default=high)
        if math.nextafter(low, 2) >= high:
            break
    return low if repetition is None else high


def budgets(sources: DataFrame, exponent: float, budget_tokens: int | None = None) -> DataFrame:
    """``source, tokens, docs, weight, budget``: the weights, and what of the token budget falls to each source.

    Without a budget it is the smallest under which every source is read whole at least once, so that nothing is left out.
    A source without tokens has weight and budget 0.
    """
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    share = F.col("tokens") / F.lit(float(total or 1))
    raw = sources.withColumn("raw", F.when(F.col("tokens") > 0, F.pow(share, F.lit(exponent))).otherwise(0.0))
    found = raw.agg(F.sum("raw").alias("z"), F.max(F.when(F.col("raw") > 0, F.col("tokens") / F.col("raw"))).alias("whole")).first()
    unit = (found.whole or 0.0) if budget_tokens is None else budget_tokens / (found.z or 1.0)
    return raw.select("source", "tokens", "docs", (F.col("raw") / F.lit(found.z or 1.0)).alias("weight"), F.round(F.col("raw") * F.lit(unit)).cast("long").alias("budget"))


def _passes() -> Column:
    """Passes over a source that its budget begins; documents without tokens are in the first."""
    return F.greatest(F.lit(1), F.ceil(F.col("budget") / F.greatest(F.col("total"), F.lit(1)))).cast("int")


def _read(sizes: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """Each different row once for every pass that reads it, with ``start``, its first copy's place in the source, and ``kept``, the copies
    that start within the budget."""
    plan = plan.select(F.col("source").alias("s"), F.col("tokens").alias("total"), "budget", F.greatest(F.lit(1), F.ceil(F.col("docs") / RANGE_DOCS)).alias("ranges"))
    read = sizes.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    read = read.withColumn("pass", F.explode(F.sequence(F.lit(0), _passes() - 1))).where("tokens > 0 OR pass = 0")
    read = read.withColumn("key", _key(seed, F.col("pass"), F.col("doc_id"), F.col("mark")))
    # The first bits of the key name the range, so ranges follow each other as keys do.
    read = read.withColumn("range", F.floor(F.col("key") / F.lit(float(2**_HASH_BITS)) * F.col("ranges")))
    held = F.col("tokens") * F.col("copies")
    ranges = read.groupBy("source", "pass", "range").agg(F.sum(held).alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("pass", "range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(F.col("source").alias("s"), F.col("pass").alias("p"), F.col("range").alias("r"), F.coalesce(before, F.lit(0)).alias("before"))
    within = F.sum(held).over(Window.partitionBy("source", "pass", "range").orderBy("key", "doc_id", "mark").rowsBetween(Window.unboundedPreceding, -1))
    found = read.withColumn("within", F.coalesce(within, F.lit(0)))
    found = found.join(ranges, F.col("source").eqNullSafe(F.col("s")) & (F.col("pass") == F.col("p")) & (F.col("range") == F.col("r")))
    found = found.withColumn("start", F.col("before") + F.col("within"))
    room = F.ceil((F.col("budget") - F.col("start")) / F.greatest(F.col("tokens"), F.lit(1)))
    kept = F.when(F.col("tokens") == 0, F.col("copies")).otherwise(F.least(F.col("copies"), room))
    return found.withColumn("kept", kept.cast("long")).where("kept > 0")


def permuted(sizes: DataFrame, plan: DataFrame, seed: str = "mix", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mixed stream: ``doc_id, source, tokens, pass, key, start, block`` for each time a document is read.

    ``start`` is the number of the source's tokens before it; documents that start within the budget are read, so the last may
    pass its end.  Block ``b`` of ``n`` holds every source's documents that start in the ``b``-th ``n``-th of its budget, so each
    block has the weights of the whole.  Documents without tokens are read once.  Equal keys are put in order of id and text.
    """
    whole = plan.agg(F.sum("budget")).first()[0] or 0
    blocks = max(1, -(-whole // block_tokens))
    found = _read(sizes, plan, seed)
    # Copies are spread in two steps, so that any number of one row is no array of one task.
    found = found.withColumn("some", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("kept") - 1) / RANGE_DOCS))))
    last = F.least(F.col("kept"), (F.col("some") + 1) * RANGE_DOCS) - 1
    found = found.withColumn("copy", F.explode(F.sequence(F.col("some") * RANGE_DOCS, last)))
    found = found.withColumn("start", F.col("start") + F.col("copy") * F.col("tokens"))
    block = F.least(F.lit(blocks - 1).cast("long"), F.expr(f"cast(start AS decimal(38,0)) * {blocks} DIV greatest(budget, 1)"))
    return found.select("doc_id", "source", "tokens", "pass", "key", "start", block.alias("block"))


def mixed(docs: DataFrame, entropy: float | None = None, repetition: float | None = None, budget_tokens: int | None = None, seed: str = "mix", block_tokens: int = BLOCK_TOKENS, **columns: str) -> DataFrame:
    """``doc_id, source, pass, block, place``: where each document stands in the mixed stream, once per time it is read.

    ``place`` orders a block by a permutation of its own.  An empty table gives no rows; rows that repeat an id, or id and text, are
    each read, and the budget ends between any two of them.
    """
    sizes = written(sized(docs, **columns), "sizes")
    sources = written(source_sizes(sizes), "sources")
    plan = budgets(sources, find_exponent(sources, entropy, repetition), budget_tokens)
    stream = permuted(sizes, plan, seed, block_tokens)
    order = _hash(seed, "block", F.col("pass").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    place = F.row_number().over(Window.partitionBy("block").orderBy(order, "doc_id", "source", "tokens"))
    return stream.select("doc_id", "source", "pass", "block", place.alias("place"))


def remixed(docs: DataFrame, entropy: float | None = None, repetition: float | None = None, budget_tokens: int | None = None, seed: str = "mix", id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The documents themselves, all columns, as often as the mix reads each.

    The stream says where each source's budget ends: after which pass and key.  That is one row per source, joined to the
    documents, so the texts are not moved.
    """
    sizes = written(sized(docs, id, source, text), "sizes")
    sources = written(source_sizes(sizes), "sources")
    plan = budgets(sources, find_exponent(sources, entropy, repetition), budget_tokens)
    reads = _read(sizes, plan, seed).where("tokens > 0")
    ends = reads.groupBy("source").agg(F.max(F.struct("pass", "key", "kept", "copies")).alias("end"))
    name, end, turn, nth = (fresh(docs, x) for x in ("_source", "_end", "_pass", "_nth"))
    ends = written(ends.select(F.col("source").alias(name), F.col("end").alias(end)), "ends")
    empty = ~F.coalesce(F.col(text).rlike(WORD), F.lit(False))
    key = _key(seed, F.col(turn), F.col(id), _mark(text))
    read = docs.join(ends, F.col(source).eqNullSafe(F.col(name)), "left")
    # Passes but the last are whole, so a pass keeps what its key allows; documents without tokens are read once.
    last = F.when(empty, 0).otherwise(F.col(end)["pass"])
    read = read.withColumn(turn, F.explode(F.when(last.isNotNull(), F.sequence(F.lit(0), last))))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    at_end = ~empty & (F.col(turn) == F.col(end)["pass"]) & (key == F.col(end)["key"])
    whole = read.where(empty | (F.col(turn) < F.col(end)["pass"]) | (key < F.col(end)["key"]) | (at_end & (F.col(end)["kept"] == F.col(end)["copies"])))
    # Of the equal rows at the end of a source's budget so many stay as the stream reads; only where the budget ends among them.
    cut = read.where(at_end & (F.col(end)["kept"] < F.col(end)["copies"]))
    if ends.where(F.col(end)["kept"] < F.col(end)["copies"]).isEmpty():
        return whole.select(*columns)
    cut = cut.withColumn(nth, F.row_number().over(Window.partitionBy(name).orderBy(F.lit(0)))).where(F.col(nth) <= F.col(end)["kept"])
    return whole.select(*columns).unionByName(cut.select(*columns))
