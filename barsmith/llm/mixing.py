"""Soft-membership mixing: document rates that bring domains to target weights.

Built-in DataFrame functions only; no Python runs on the executors.

1. Classifier. A labelled table (doc_id, domain) names the domain of some documents. Features
   of a document are its distinct lower-case words, and two shape words: how much of it
   is blanks and punctuation, how many of its words differ. On a bounded sample
   of labelled rows (about ``sample_rows``, by a hash of the id) documents are
   counted per feature and domain. Features that are
   ``min_lift`` times as frequent in a domain as in the others and significant by the G
   statistic make a Bernoulli naive Bayes model, the ``max_features`` best of each domain: one
   row per feature, a weight per domain, and a base weight for the absence of all of them.
   Significant means a chance of ``significance`` that any of the sample's features would get
   there if none differed between domains (Bonferroni), so the bar follows the sample;
   ``min_g`` sets it by hand.
2. Posteriors of every document, from its whole text.
3. Rates. With n the tokens (words) of a document and p its posteriors, rates w >= 0 minimise
   the sum over domains of (sum of w n p - target)^2 / mass, mass being the domain's expected
   tokens at rate 1. Projected gradient from w = 1, in the metric of n, has curvature 1 at
   most, so a step of 1 descends: w <- max(0, w - sum of p (got - target) / mass). A
   document's rate is a function of its posteriors, so documents with equal posteriors are
   one row with their tokens summed (exactly the same result), and an iteration is one
   distributed aggregation that gives the driver one number per domain. A last step, by Newton's
   method on the same numbers, closes what the gradient leaves. Rates follow
   from the list of those numbers; no per-document state is stored.

No shuffle carries text but the join of the labelled sample; the result is computed in
one pass over the documents.

Targets are weights over domains (scaled to sum 1) of ``total`` tokens (default: as many as
the documents have). Domains without labelled rows in the sample have no posterior, and
their weight can't be reached. Without any labelled row every rate is 1. Where no feature is
significant, all posteriors are the domains' shares, with a warning.

Null texts are empty, with zero tokens; they have posteriors and a rate all the same. Rows with
null domain, or a domain without target, teach nothing; documents with equal posteriors have equal rates, and of
equal posteriors the first domain by name is the likeliest; ids that repeat in the table teach
with each row. Null ids are never labelled. Empty tables give empty results. Extra columns
pass through; result columns get underscores in front where their names are taken.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import free_name, stored

SEPARATORS = r"[\s\p{Punct}]+"


def with_features(df: DataFrame, text: Column, n_tokens: str, found: str, wanted: list[str] | None = None) -> DataFrame:
    """``df`` with the number of words and the features: distinct words and the two shape words
    (which hold a blank, as no word does), or those of them that are ``wanted``. Each step is a
    column of its own, so that Spark computes it once."""
    w, u = (free_name([*df.columns, n_tokens, found], c) for c in ("_words", "_distinct"))
    t = F.coalesce(text, F.lit(""))
    out = df.withColumn(w, F.array_remove(F.split(F.lower(t), SEPARATORS), "")).withColumn(u, F.array_distinct(w))
    n = F.size(w).cast("long")

    def shape(name: str, share: Column, steps: int) -> Column:
        return F.concat(F.lit(f"{name} "), F.floor(share * steps).cast("string"))

    marks = 1 - F.length(F.array_join(w, "")) / F.greatest(F.length(t), F.lit(1))
    differ = F.size(u) / F.greatest(n, F.lit(1))
    every = F.concat(F.col(u), F.array(shape("marks", marks, 20), shape("differ", differ, 10)))
    if wanted is not None:
        every = F.array_intersect(every, F.array(*[F.lit(f) for f in wanted]).cast("array<string>"))
    return out.withColumns({n_tokens: n, found: every}).drop(w, u)


@dataclass
class Model:
    """Domains, their base weights, and per feature a weight for each domain."""

    domains: list[str]
    base: list[float]
    weights: dict[str, list[float]]


def chance_of(g: float, freedom: int) -> float:
    """The chance that a chi-squared variable of ``freedom`` degrees is ``g`` or more."""
    x, a = g / 2, 0.5 if freedom % 2 else 1.0
    chance = math.erfc(math.sqrt(x)) if freedom % 2 else math.exp(-x)
    while 2 * a < freedom:
        chance += x ** a * math.exp(-x) / math.gamma(a + 1)
        a += 1
    return chance


def least_g(features: int, domains: int, significance: float) -> float:
    """The G statistic that one of ``features`` reaches by chance with that probability."""
    low, high = 0.0, 1000.0
    for _ in range(60):
        g = (low + high) / 2
        low, high = (g, high) if chance_of(g, max(domains - 1, 1)) * features > significance else (low, g)
    return high


def learn(docs: DataFrame, labelled: DataFrame, domains: list[str], *, text: str = "text", doc_id: str = "doc_id", domain: str = "domain",
          sample_rows: int = 20_000, max_features: int = 128, min_g: float | None = None,
          significance: float = 0.01, min_lift: float = 2.5, smooth: float = 0.5) -> Model | None:
    known = labelled.filter(F.col(domain).isin(domains) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(domain).alias("_d"))
    rate = min(1.0, sample_rows / max(known.count(), 1))
    chosen = known.filter(F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("mixing")), F.lit(1 << 20)) < rate * (1 << 20))
    sample = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_x")).join(chosen, "_id").select("_d", "_x")
    seen = stored(with_features(sample, F.col("_x"), "_n", "_f").select("_d", "_f"), "mixing-sample")
    sizes = {r["_d"]: r["n"] for r in seen.groupBy("_d").agg(F.count(F.lit(1)).alias("n")).collect()}
    named = [d for d in domains if d in sizes]
    if not named:
        return None
    rows = sum(sizes.values())
    counted = stored(seen.select("_d", F.explode("_f").alias("f")).groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("_d") == d).alias(f"n{i}") for i, d in enumerate(named)]), "mixing-features")

    def g_part(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, 2 * observed * F.log(observed / expected)).otherwise(0.0)

    g = F.lit(0.0)
    for i, d in enumerate(named):
        g = g + g_part(F.col(f"n{i}"), F.col("n") * sizes[d] / rows) + g_part(F.lit(sizes[d]) - F.col(f"n{i}"), (F.lit(rows) - F.col("n")) * sizes[d] / rows)
    lifts = [((F.col(f"n{i}") + smooth) / (sizes[d] + 2 * smooth))
             / ((F.col("n") - F.col(f"n{i}") + smooth) / (rows - sizes[d] + 2 * smooth)) for i, d in enumerate(named)]
    if min_g is None:
        min_g = least_g(max(counted.count(), 1), len(named), significance)
    bar = counted.filter(F.col("n") < rows).withColumn("g", g).filter(F.col("g") >= min_g)
    best = {r["f"]: r for lift in lifts for r in bar.filter(lift >= min_lift).orderBy(F.desc("g"), "f").limit(max_features).collect()}
    top = sorted(best.values(), key=lambda r: (-r["g"], r["f"]))

    if not top and len(named) > 1:
        warnings.warn(f"no word tells the domains apart in {rows} labelled rows: all posteriors are equal", stacklevel=2)

    def share(count: int, d: str) -> float:
        return (count + smooth) / (sizes[d] + 2 * smooth)

    base = [math.log(sizes[d] / rows) + sum(math.log(1 - share(r[f"n{i}"], d)) for r in top) for i, d in enumerate(named)]
    weights = {r["f"]: [math.log(share(r[f"n{i}"], d) / (1 - share(r[f"n{i}"], d))) for i, d in enumerate(named)] for r in top}
    return Model(named, base, weights)


def with_posteriors(df: DataFrame, model: Model, text: Column, n_tokens: str, named: list[str]) -> DataFrame:
    """``df`` with the number of words and one column of posteriors for each domain."""
    f = free_name([*df.columns, n_tokens, *named], "_features")
    top = f + "_top"
    out = with_features(df, text, n_tokens, f, list(model.weights))

    def score(i: int) -> Column:
        start = F.lit(float(model.base[i]))
        if not model.weights:
            return start
        table = F.create_map(*[x for k, ws in model.weights.items() for x in (F.lit(k), F.lit(float(ws[i])))])
        return F.aggregate(f, start, lambda acc, k: acc + F.element_at(table, k))

    out = out.withColumns({p: score(i) for i, p in enumerate(named)})
    out = out.withColumn(top, F.greatest(*named) if len(named) > 1 else F.col(named[0]))
    out = out.withColumns({p: F.exp(F.col(p) - F.col(top)) for p in named})
    out = out.withColumn(top, sum((F.col(p) for p in named[1:]), F.col(named[0])))
    return out.withColumns({p: F.col(p) / F.col(top) for p in named}).drop(f, top)


def rate_of(named: list[str], steps: list[list[float]]) -> Column:
    """The rate after the given gradient steps, each a number per domain."""
    if not steps:
        return F.lit(1.0)
    listed = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
    return F.aggregate(listed, F.lit(1.0), lambda w, s: F.greatest(
        F.lit(0.0), w - sum((F.col(p) * s[i] for i, p in enumerate(named) if i), F.col(named[0]) * s[0])))


def fit_rates(mass_of: DataFrame, targets: list[float], total: float | None, *, iterations: int, tolerance: float) -> list[list[float]]:
    """Gradient steps for rows of posteriors (p0, p1, ...) and n, the tokens that have them."""
    named = [f"p{i}" for i in range(len(targets))]

    def totals(w: Column) -> list[float]:
        row = mass_of.withColumn("w", w * F.col("n")).agg(*[F.sum(F.col("w") * F.col(p)) for p in named]).first()
        return [x or 0.0 for x in row]

    mass = totals(F.lit(1.0))
    wanted = [x * (sum(mass) if total is None else total) for x in targets]
    got, steps, last = mass, [], float("inf")
    for _ in range(iterations):
        loss = sum((g - t) ** 2 / m for g, t, m in zip(got, wanted, mass, strict=True) if m > 0)
        if loss <= tolerance ** 2 * sum(mass) or last - loss <= tolerance * loss:
            break
        last = loss
        steps.append([(g - t) / m if m > 0 else 0.0 for g, t, m in zip(got, wanted, mass, strict=True)])
        got = totals(rate_of(named, steps))
    return steps


def dual_step(mass_of: DataFrame, targets: list[float], total: float | None, steps: list[list[float]], *,
              tolerance: float, iterations: int = 30) -> tuple[list[list[float]], list[float], list[float]]:
    """The gradient steps with one more that meets the targets, if they can be met: (steps, tokens of
    each domain, tokens wanted).

    Gradient steps slow down where posteriors hardly differ. Of all rates that match the targets, those
    nearest to the gradient's have the form max(0, w - sum of p s), a step of the same kind with one
    number per domain. Newton's method finds them: an iteration is one aggregation that
    gives the driver the domains' totals and the matrix of sums of n p p' over rates above 0.
    """
    k = len(targets)
    named = [f"p{i}" for i in range(k)]
    mass = [x or 0.0 for x in mass_of.agg(*[F.sum(F.col("n") * F.col(p)) for p in named]).first()]
    wanted = [x * (sum(mass) if total is None else total) for x in targets]
    live = [i for i in range(k) if mass[i] > 0]
    pairs = [(i, j) for i in live for j in live if i <= j]
    # the gradient's rates once, so that an iteration is one step long
    start = stored(mass_of.withColumn("w", rate_of(named, steps)), "mixing-rates") if live else mass_of

    def look(s: list[float]) -> tuple[list[float], list[list[float]]]:
        w = F.greatest(F.lit(0.0), F.col("w") - sum((F.col(p) * x for p, x in zip(named, s, strict=True)), F.lit(0.0)))
        above = F.when(F.col("v") > 0, F.col("n")).otherwise(0.0)
        row = start.withColumn("v", w).agg(*[F.sum(F.col("v") * F.col("n") * F.col(p)) for p in named],
                                           *[F.sum(above * F.col(named[i]) * F.col(named[j])) for i, j in pairs]).first()
        got = [x or 0.0 for x in row[:k]]
        h = [[0.0] * k for _ in range(k)]
        for (i, j), x in zip(pairs, row[k:], strict=True):
            h[i][j] = h[j][i] = x or 0.0
        return got, h

    def missed(got: list[float]) -> float:
        return max([abs(got[i] - wanted[i]) for i in live], default=0.0)

    s = [0.0] * k
    if not live:
        return steps, mass, wanted
    got, h = look(s)
    for _ in range(iterations):
        if missed(got) <= tolerance * sum(wanted):
            break
        move = solve([[h[i][j] for j in live] for i in live], [got[i] - wanted[i] for i in live])
        share, better = 1.0, False
        while share > 1e-3:  # the full move may overshoot where rates fall to 0 or rise from it
            tried = list(s)
            for i, x in zip(live, move, strict=True):
                tried[i] += share * x
            new, new_h = look(tried)
            if missed(new) < missed(got) * (1 - share / 10):
                s, got, h, better = tried, new, new_h, True
                break
            share /= 4
        if not better:
            break
    return ([*steps, s] if any(s) else steps), got, wanted


def solve(a: list[list[float]], b: list[float]) -> list[float]:
    """x with a x = b for a small symmetric matrix, by elimination; a little is added to the
    diagonal, so that domains which posteriors can't tell apart share the move."""
    n = len(b)
    ridge = 1e-9 * max(max(a[i][i] for i in range(n)), 1e-300)
    rows = [[*(a[i][j] + (ridge if i == j else 0.0) for j in range(n)), b[i]] for i in range(n)]
    for c in range(n):
        top = max(range(c, n), key=lambda r: abs(rows[r][c]))
        rows[c], rows[top] = rows[top], rows[c]
        for r in range(n):
            if r != c:
                f = rows[r][c] / rows[c][c]
                rows[r] = [x - f * y for x, y in zip(rows[r], rows[c], strict=True)]
    return [rows[i][n] / rows[i][i] for i in range(n)]


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], *, text: str = "text", doc_id: str = "doc_id",
        domain: str = "domain", total: float | None = None, iterations: int = 10, tolerance: float = 5e-4, **learning) -> DataFrame:
    """``docs`` with n_tokens, posteriors (map of domain to probability), domain (the likeliest)
    and rate (expected copies in the mix, 0 or more).

    Warns, with each domain's share, where targets are missed by more than ``tolerance`` of all tokens: no
    nonnegative rates of these posteriors reach them."""
    if not targets or min(targets.values()) < 0 or sum(targets.values()) <= 0:
        raise ValueError("targets are nonnegative weights, one at least positive")
    taken = [*docs.columns]
    names = [free_name(taken, c) for c in ("n_tokens", "posteriors", "domain", "rate")]
    x = F.col(f"`{text}`")
    model = learn(docs, labelled, sorted(targets), text=text, doc_id=doc_id, domain=domain, **learning)
    if model is None:
        found = free_name([*taken, *names], "_features")
        out = with_features(docs, x, names[0], found).drop(found)
        return out.withColumns({names[1]: F.lit(None).cast("map<string,double>"), names[2]: F.lit(None).cast("string"), names[3]: F.lit(1.0)})
    weights = [targets[d] / sum(targets.values()) for d in model.domains]
    named = [f"p{i}" for i in range(len(model.domains))]
    mass_of = stored(with_posteriors(docs.select(x.alias("x")), model, F.col("x"), "n", named).filter("n > 0")
                     .groupBy(*named).agg(F.sum("n").cast("double").alias("n")), "mixing-mass")
    steps = fit_rates(mass_of, weights, total, iterations=iterations, tolerance=tolerance)
    steps, got, wanted = dual_step(mass_of, weights, total, steps, tolerance=tolerance)
    if max((abs(g - t) for g, t in zip(got, wanted, strict=True)), default=0.0) > 2 * tolerance * sum(wanted):
        shares = {d: (round(g / sum(wanted), 4), round(t / sum(wanted), 4)) for d, g, t in zip(model.domains, got, wanted, strict=True)}
        warnings.warn(f"targets out of reach, (share, target) by domain: {shares}", stacklevel=2)
    own = [free_name(taken, f"_posterior_{i}") for i in range(len(named))]
    # A row number is not deterministic, so a caller's filter on the rate stays above this
    # step: pushed below it, the posteriors would be computed again for every gradient step.
    row = free_name([*taken, *own], "_row")
    out = with_posteriors(docs, model, x, names[0], own).withColumn(row, F.monotonically_increasing_id())
    keys = F.array(*[F.lit(d) for d in model.domains])
    likeliest = F.element_at(keys, F.array_position(F.array(*own), F.greatest(*own) if len(own) > 1 else F.col(own[0])).cast("int"))
    return out.withColumns({names[1]: F.map_from_arrays(keys, F.array(*own)), names[2]: likeliest, names[3]: F.when(F.col(row) >= 0, rate_of(own, steps))}).drop(*own, row)
