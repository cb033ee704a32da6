"""Mixing sources to target weights by iterative proportional fitting (native).

Documents fall into cells (source, language, topic). The cells' token weights
are raked in turn to the target marginals of source, language and topic; a
document is then sampled with its cell's calibrated probability.

A target is a share per value. Shares may be given; by default they are the
natural token shares raised to ``alpha`` and normalised (tempering: rare
sources are raised, frequent ones lowered). A value can supply at most all its
tokens, and so at most the share ``tokens / (keep * all)``: a target above that
is cut down to it and the others of its marginal are raised in proportion. The
result is the reachable target, and what is raked to. The cells of a value that
is cut give all they have from the start (unless they alone would pass another
target) and the others are raked to what is left. After each sweep a cell's
weight is held to what it can supply, ``tokens / keep``, so that no probability
passes one; the other cells take up the rest in the next sweep. Sweeps end as
soon as every marginal is within ``TOLERANCE`` of its reachable target, as a
share of all tokens, or a sweep changes nothing more (marginals that can be
reached one by one, but not together), after ``MAX_SWEEPS`` at the latest.

Nothing is missed silently: ``achieved`` gives target, reachable and achieved
share of every value; ``mixed`` logs how many values miss their target and the
worst of them, and with ``strict`` raises ``TargetsMissed``. A lower ``keep``
draws fewer documents and brings more targets within reach.

Sampling is a function of the seed and the document's id (its text where the
id is null): the same documents are drawn on any cluster, after any retry, and
repeated rows of one id are drawn together or not at all.

Defined cases: a null source, language or topic is the value ``(none)``. Null
and empty texts have no tokens; their weight is one token, so they follow
their cell's probability. A value without a given target share gets share 0
and is never drawn. An empty table gives an empty result. Input columns are
carried whatever their names.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, packed, written

DIMS = ("source", "lang", "topic")
ALPHA = {"source": 0.5, "lang": 0.7, "topic": 0.5}
TOLERANCE = 1e-3
STALL = 0.01  # of the tolerance: a sweep that brings the worst value no nearer than this is the last
MAX_SWEEPS = 100
KEEP = 0.5
NONE = "(none)"

log = logging.getLogger("tidemark.mixing")


class TargetsMissed(ValueError):
    """Some values cannot have their target share at this ``keep``."""


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def form_topic(text: Column) -> Column:
    """A coarse topic by form, for tables without a topic column: tabular text
    (a bar at every fourth word or more), else by length: note (< 100 words),
    article (< 1000) or long."""
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    n = n_tokens(text)
    return (
        F.when(n == 0, "empty").when(bars * 4 >= n, "tabular").when(n < 100, "note").when(n < 1000, "article").otherwise("long")
    )


def _marginal(cells: DataFrame, dim: str, keep: float, alpha: float, given: Mapping[str, float] | None) -> DataFrame:
    """``(dim, wanted, target, cut)``: target tokens per value as asked for, as far as they can be supplied, and whether that is all.

    The reachable target is ``least(level * share, tokens / keep)``; the level
    that uses all tokens is found by raising it as long as values are cut.
    """
    per = cells.groupBy(dim).agg(F.sum("tokens").alias("t"))
    if given is not None:
        shares = F.create_map(*[x for k, v in given.items() for x in (F.lit(k), F.lit(float(v)))])
        per = per.select(dim, "t", F.coalesce(F.element_at(shares, F.col(dim)), F.lit(0.0)).alias("share"))
    else:
        per = per.select(dim, "t", F.pow(F.col("t").cast("double"), F.lit(alpha)).alias("share"))
    per = written(per, f"mix-{dim}")
    all_t, all_share = per.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("share"), F.lit(0.0))).first()  # two numbers
    cap = F.col("t") / F.lit(keep)
    level = all_t / (all_share or 1.0)
    wanted = F.lit(level) * F.col("share")
    while all_t:
        cut = F.lit(level) * F.col("share") >= cap
        held, free = per.agg(F.coalesce(F.sum(F.when(cut, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~cut, F.col("share"))), F.lit(0.0))).first()  # two numbers
        if not free or (all_t - held) / free <= level * (1 + 1e-12):
            break
        level = (all_t - held) / free
    return per.select(dim, wanted.alias("wanted"), F.least(F.lit(float(level)) * F.col("share"), cap).alias("target"), (F.lit(float(level)) * F.col("share") >= cap).alias("cut"))


def _targets(cells: DataFrame, keep: float, alpha: Mapping[str, float], targets: Mapping[str, Mapping[str, float]] | None) -> dict[str, DataFrame]:
    """The marginals, with equal totals: where given shares leave values out, the least total that all can reach."""
    found = {d: _marginal(cells, d, keep, alpha[d], (targets or {}).get(d)) for d in DIMS}
    totals = {d: x.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0] for d, x in found.items()}  # a number each
    least = min(totals.values())
    return {d: written(x.withColumn("target", F.col("target") * F.lit(least / totals[d] if totals[d] > least * (1 + 1e-9) else 1.0)), f"mix-target-{d}") for d, x in found.items()}


def _start(cells: DataFrame, keep: float, wanted: Mapping[str, DataFrame]) -> DataFrame:
    """Cells with their first ``weight`` and whether it is ``held``: of cells that a cut value makes give all they have."""
    state = cells
    for d in DIMS:
        state = state.join(wanted[d].select(d, F.col("cut").alias(f"cut_{d}"), (F.col("target") > 0).alias(f"open_{d}")), d)
    given = (F.col("cut_source") | F.col("cut_lang") | F.col("cut_topic")) & F.col("open_source") & F.col("open_lang") & F.col("open_topic")
    state = written(state.select(*DIMS, "tokens", given.alias("given")), "mix-cells")
    for d in DIMS:
        own = state.groupBy(d).agg(F.coalesce(F.sum(F.when(F.col("given"), F.col("tokens") / F.lit(keep))), F.lit(0.0)).alias("all"))
        fits = own.join(wanted[d], d).select(d, (F.col("all") <= F.col("target") * F.lit(1 + 1e-9)).alias(f"fits_{d}"))
        state = state.join(fits, d)
    held = F.col("given") & F.col("fits_source") & F.col("fits_lang") & F.col("fits_topic")
    state = state.select(*DIMS, "tokens", held.alias("held"))
    return written(state.withColumn("weight", F.when(F.col("held"), F.col("tokens") / F.lit(keep)).otherwise(F.col("tokens").cast("double"))), "mix-start")


def _all(wanted: Mapping[str, DataFrame]) -> DataFrame:
    """``(dim, value, wanted, target)`` of all marginals."""
    return reduce(DataFrame.unionByName, [x.select(F.lit(d).alias("dim"), F.col(d).alias("value"), "wanted", "target") for d, x in wanted.items()])


def _have(state: DataFrame) -> DataFrame:
    """``(dim, value, have)``: the weight of each value of each marginal, by one aggregate."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("value")) for d in DIMS])).alias("v")
    return state.select("weight", each).groupBy("v.dim", "v.value").agg(F.sum("weight").alias("have"))


def rake(
    cells: DataFrame,
    keep: float = KEEP,
    alpha: Mapping[str, float] = ALPHA,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    tolerance: float = TOLERANCE,
    max_sweeps: int = MAX_SWEEPS,
) -> tuple[DataFrame, DataFrame]:
    """Cells ``(source, lang, topic, tokens)`` with their raked ``weight``, and the marginals they were raked to.

    The work is on cells and marginals only, never on documents. Each sweep is
    one written table, so lineage and plan stay short.
    """
    cells = written(cells, "mix-cells")
    wanted = _targets(cells, keep, alpha, targets)
    marginals = written(_all(wanted), "mix-marginals")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    state = _start(cells, keep, wanted)
    off = float("inf")
    for _ in range(max_sweeps):
        for d in DIMS:
            have = [F.coalesce(F.sum(F.when(on, F.col("weight"))), F.lit(0.0)) for on in (F.col("held"), ~F.col("held"))]
            now = state.groupBy(d).agg(have[0].alias("fixed"), have[1].alias("free")).join(wanted[d], d)
            factor = now.select(d, F.when(F.col("free") > 0, F.greatest(F.col("target") - F.col("fixed"), F.lit(0.0)) / F.col("free")).otherwise(0.0).alias("factor"))
            weight = F.when(F.col("held"), F.col("weight")).otherwise(F.col("weight") * F.col("factor"))
            state = state.join(factor, d).select(*DIMS, "tokens", "held", weight.alias("weight"))
        state = written(state.withColumn("weight", F.least("weight", F.col("tokens") / F.lit(keep))), "mix-sweep")
        errors = _have(state).join(marginals, ["dim", "value"]).agg(F.max(F.abs(F.col("have") - F.col("target"))).alias("off"))
        off, before = (errors.first()[0] if total else 0.0), off
        if off <= tolerance * total or abs(before - off) <= STALL * tolerance * total:
            break
    return state, marginals


def achieved(state: DataFrame, marginals: DataFrame) -> DataFrame:
    """``(dim, value, target_share, reachable_share, achieved_share)`` of raked cells, one row per value of each marginal."""
    found = written(_have(state).join(marginals, ["dim", "value"]), "mix-achieved")
    sums = found.groupBy("dim").agg(*[F.sum(c).alias(f"all_{c}") for c in ("wanted", "target", "have")])  # a row per marginal
    share = lambda c: F.when(F.col(f"all_{c}") > 0, F.col(c) / F.col(f"all_{c}")).otherwise(0.0)
    return found.join(sums, "dim").select("dim", "value", share("wanted").alias("target_share"), share("target").alias("reachable_share"), share("have").alias("achieved_share"))


def _told(state: DataFrame, marginals: DataFrame, strict: bool, keep: float, tolerance: float) -> None:
    """Say which values miss their target share by more than ten times the tolerance."""
    off = F.abs(F.col("achieved_share") - F.col("target_share"))
    missed = written(achieved(state, marginals).filter(off > 10 * tolerance), "mix-missed")
    worst = missed.orderBy(off.desc(), "dim", "value").limit(5).collect()  # a report of the five worst
    if worst:
        text = ", ".join(f"{r['dim']} {r['value']}: {r['achieved_share']:.3f} of {r['target_share']:.3f}" for r in worst)
        text = f"{missed.count()} target shares are missed at keep={keep}: {text}"
        if strict:
            raise TargetsMissed(text)
        log.warning(text)


def mixed(
    docs: DataFrame,
    topic: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    keep: float = KEEP,
    alpha: Mapping[str, float] = ALPHA,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    seed: str = "mix",
    strict: bool = False,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``row`` (input row), ``source, lang, topic, tokens, prob, sampled``."""
    named = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    base = docs.select(
        packed(docs).alias("row"),
        named(col(source)).alias("source"),
        named(col(lang)).alias("lang"),
        named(form_topic(col(text)) if topic is None else topic).alias("topic"),
        F.greatest(n_tokens(col(text)), F.lit(1)).cast("long").alias("tokens"),
        F.coalesce(col(doc_id).cast("string"), F.md5(col(text).cast("binary")), F.lit("")).alias("key"),
    )
    cells = base.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens"))
    state, marginals = rake(cells, keep, alpha, targets, tolerance)
    _told(state, marginals, strict, keep, tolerance)
    prob = state.select(*DIMS, F.least(F.lit(1.0), F.lit(keep) * F.col("weight") / F.col("tokens")).alias("prob"))
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("key"))), 1, 8), 16, 10).cast("double") / 4294967296.0
    # The cells are small but their number is not bounded: AQE broadcasts them while below its threshold.
    return base.join(prob, list(DIMS)).select("row", *DIMS, "tokens", "prob", (u < F.col("prob")).alias("sampled"))
