"""Secret scans over a content-addressed ledger, in DataFrame operations only.

Every version of every path has an address, the SHA-256 of its text; equal texts are one blob.  The ledger keeps, for each blob,
the rule versions that have scanned it and the spans they found.  A scan looks only at pairs of blob and rule version that the
ledger lacks, adds them, and joins what is found back to all paths.  So a second scan of a grown history reads the new blobs
alone, and a changed rule is run again without the others.

Positions come from one pass of a pattern each: its matches, and the gaps between them, whose lengths add up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.shared import written


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  Matches are leftmost and do not overlap; those whose ``group`` is shorter than ``least`` are dropped.

    ``hint`` is a cheaper pattern that every text with a match holds.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hint: str | None = None
    version: int = 1


_KEYWORD = "(?i:(password|passwd|secret|token|api_?key))"

#: The base kinds, in their listed order.  Runs shorter than the least length cannot hold a match of these two patterns.
BASE = (
    Rule("assign", _KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=12, hint=_KEYWORD),
    Rule("access", r"AKIA[A-Z0-9]{14,}", hint="AKIA"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: What the ledger adds to them.
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", hint="-----BEGIN "),
)
RULES = BASE + ADDED

_SPANS = "array<struct<start:bigint,end:bigint>>"
#: Matches whose positions are added up together.
RUN = 256


def spans(text: Column, rule: Rule) -> Column:
    """Spans of a rule's matches in a text, in code points, end exclusive, in order."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, rule.pattern, -1)
    values = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    pieces = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("match")))
    pieces = F.zip_with(pieces, values, lambda p, value: F.struct(p["gap"].alias("gap"), p["match"].alias("match"), (F.length(value) >= rule.least).alias("good")))
    return F.when(text.rlike(rule.hint or rule.pattern), _let(pieces, _placed)).otherwise(F.array().cast(_SPANS))


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _placed(pieces: Column) -> Column:
    """Spans of the good ones of some ``gap, match, good`` pieces.

    An array that grows by a match at a time is copied each time.  So pieces are cut into runs of ``RUN``: lengths are summed by run,
    runs start where the sums before them end, and only within a run do arrays grow.
    """
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(pieces) - 1) / RUN).cast("int"))), lambda i: F.slice(pieces, i * RUN + 1, RUN))
    return _let(runs, lambda cut: _let(_starts(F.transform(cut, _length)), lambda starts: F.flatten(F.transform(cut, lambda run, i: _within(run, F.get(starts, i))))))


def _length(run: Column) -> Column:
    return F.aggregate(run, F.lit(0).cast("bigint"), lambda n, p: n + p["gap"] + p["match"])


def _starts(lengths: Column) -> Column:
    """Sums of all lengths before each, and of all."""
    none = F.struct(F.lit(0).cast("bigint").alias("at"), F.array(F.lit(0).cast("bigint")).alias("all"))
    grown = lambda held, n: F.struct((held["at"] + n).alias("at"), F.concat(held["all"], F.array(held["at"] + n)).alias("all"))
    return F.aggregate(lengths, none, grown, lambda held: held["all"])


def _within(run: Column, start: Column) -> Column:
    def step(held: Column, p: Column) -> Column:
        low = held["at"] + p["gap"]
        high = low + p["match"]
        one = F.array(F.struct(low.alias("start"), high.alias("end"))).cast(_SPANS)
        return F.struct(high.alias("at"), F.when(p["good"], F.concat(held["found"], one)).otherwise(held["found"]).alias("found"))

    return F.aggregate(run, F.struct(start.alias("at"), F.array().cast(_SPANS).alias("found")), step, lambda held: held["found"])


def address(text: str = "text") -> Column:
    """The blob of a text; a NULL text is an empty one."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The ledger after a scan: ``blob, entries`` of every blob of ``versions`` and of ``ledger``, and ``scans``.

    ``entries`` maps a kind to its rule version and spans; ``scans`` counts the rules that this scan ran on the blob, 0 for what
    was known.  Blobs of which the ledger has every rule version are not scanned.  The result is written, so it can be the next
    scan's ledger.
    """
    # Copies are dropped before and after the exchange, so a blob that a third of all paths hold moves once per task.
    blobs = versions.select(address(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text")).dropDuplicates(["blob"])
    if ledger is None:
        known = lambda rule: F.lit(False)
        joined = blobs
    else:
        joined = blobs.join(ledger.select("blob", F.col("entries").alias("old")), "blob", "left")
        known = lambda rule: F.coalesce(F.col("old")[rule.kind]["version"] == rule.version, F.lit(False))
    entry = f"struct<version:int,spans:{_SPANS}>"
    parts, scans = [], F.lit(0)
    for rule in rules:
        fresh = F.struct(F.lit(rule.version).alias("version"), spans(F.col("text"), rule).alias("spans")).cast(entry)
        parts += [F.lit(rule.kind), fresh if ledger is None else F.when(known(rule), F.col("old")[rule.kind]).otherwise(fresh)]
        scans = scans + F.when(known(rule), 0).otherwise(1)
    scanned = joined.select("blob", F.create_map(*parts).alias("entries"), scans.alias("scans"))
    if ledger is None:
        return written(scanned, "ledger")
    rest = ledger.join(blobs.select("blob"), "blob", "left_anti").select("blob", "entries", F.lit(0).alias("scans"))
    return written(scanned.unionByName(rest), "ledger")


def _listed(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of all spans of some kinds, by start, then kind as listed."""
    ranked = lambda rank: lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"))
    parts = [F.transform(F.col("entries")[k]["spans"], ranked(i)) for i, k in enumerate(kinds)]
    names = F.array(*[F.lit(k) for k in kinds])
    ordered = F.array_sort(F.concat(*parts))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE, path: str = "doc_id", text: str = "text") -> DataFrame:
    """What the ledger has of each path's text: counts of the base kinds, a digest of their spans, and all spans as text.

    Every row comes back; other columns take no part.
    """
    counts = [F.size(F.col("entries")[r.kind]["spans"]).cast("bigint").alias(f"n_{r.kind}") for r in base]
    listed = ledger.select("blob", *counts, F.sha2(_listed(tuple(r.kind for r in base)).cast("binary"), 256).alias("base_sha256"), _listed(tuple(r.kind for r in rules)).alias("spans"))
    return versions.select(F.col(path), address(text).alias("blob")).join(listed, "blob").drop("blob")
