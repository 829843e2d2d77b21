"""Soft-membership mixing: nonnegative document rates that meet target weights of domains.

A naive Bayes classifier of hashed words, fitted on a bounded sample of the
labelled rows, gives every document a posterior over the domains: how much of
it belongs to each. The rates r >= 0 minimise the squared differences between
the domains' expected token totals sum(r * tokens * posterior) and their targets
and change documents as little as that needs: r is 1 + posterior * price, cut at
its bound, for one price of each domain. The prices are found by safeguarded
Newton steps on the (convex) dual. A step is one aggregation over all documents,
or two; only sums over domains and pairs of domains reach the driver.

All of it is DataFrame work. Null text counts as empty: no words, the prior as
posterior and no weight in the totals; its rate comes from the same steps.
Repeated rows are documents of their own. Extra columns are never read by the
classifier and are kept by ``apply_rates``. Rows without a label take no part in
the fit; without any labelled row there is one domain and, but for sources, all
rates are 1. Every labelled domain has a target. Sources are known from the rows,
so no posterior is fitted for them: where ``labelled`` has a ``source`` column, each
source of the documents (null is one) has a target of its own beside the domains.
"""

from __future__ import annotations

import logging

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import staged

SAMPLE = 500  # labelled documents of each domain that the classifier is fitted on, at most
PARTS = 64  # of a domain, ranked apart before the domain
OTHER = "other"  # the one domain where no row has a label
BUCKETS = 4096  # word buckets
SATURATION = 40.0  # words after which more words hardly sharpen a posterior
STEPS = 200
TOLERANCE = 1e-6  # of the total, in each domain
SETTLED = 1e-9  # of the total: the dual's gradient at which unreachable targets are as near as can be
DAMPING = 1e-12  # of the total: weight of the change of rates beside the squared gaps
CUTS = [0.5 ** i for i in range(1, 48)]  # shares of a step that is too long

log = logging.getLogger(__name__)


def words(text: Column) -> Column:
    """The words of a text: lower case, between single spaces and line ends, none empty."""
    return F.array_remove(F.split(F.translate(F.lower(F.coalesce(text, F.lit(""))), "\n\t\r", "   "), " "), "")


def _exploded(docs: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    # explode_outer: a plain explode would have every text split twice (a filter on the array's size is inferred).
    rows = docs.select(*keys, F.explode_outer(words(F.col(text_col))).alias("_word")).where("_word IS NOT NULL")
    return rows.select(*keys, F.pmod(F.xxhash64("_word"), F.lit(BUCKETS)).cast("int").alias("_bucket"))


def fit_domains(docs: DataFrame, labelled: DataFrame, *, id_col: str, text_col: str, domain_col: str,
                sample: int = SAMPLE) -> tuple[list[str], DataFrame]:
    """(domains, table of ``_bucket`` and one log-likelihood array ``_ll`` by domain).

    ``labelled`` holds ids with their domain; the texts of at most ``sample`` ids of
    each domain, the smallest by hash, are read from ``docs``. The table has
    ``BUCKETS`` + 1 rows: bucket -1 holds the log priors.
    """
    spark = docs.sparkSession
    rows = staged(labelled.select(F.col(id_col).alias("_id"), F.col(domain_col).cast("string").alias("_dom"))
                  .where("_dom IS NOT NULL AND _id IS NOT NULL").distinct())
    got = {r["_dom"]: r["n"] for r in rows.groupBy("_dom").agg(F.count("*").alias("n")).collect()}
    domains = sorted(got)
    if not domains:
        return [OTHER], spark.range(-1, BUCKETS).select(
            F.col("id").cast("int").alias("_bucket"), F.array(F.lit(0.0)).alias("_ll"))
    # Ranked within parts of a domain first, so that no task gets a domain that holds a third of all rows.
    chosen = rows.withColumn("_part", F.pmod(F.xxhash64("_id", F.lit("part")), F.lit(PARTS)).cast("int"))
    for by in (("_dom", "_part"), ("_dom",)):
        first = Window.partitionBy(*by).orderBy(F.xxhash64("_id"), "_id")
        chosen = chosen.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= sample).drop("_at")
    chosen = chosen.drop("_part")
    texts = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
             .join(F.broadcast(chosen), "_id").groupBy("_id", "_dom").agg(F.min("_t").alias("_t")))  # of repeated ids the smallest text
    counts = _exploded(texts, ["_dom"], "_t").groupBy("_bucket").pivot("_dom", domains).count()
    # Positions instead of the names that pivot() makes from the domains.
    counts = counts.toDF("_bucket", *[f"c{i}" for i in range(len(domains))])
    full = staged(spark.range(BUCKETS).select(F.col("id").cast("int").alias("_bucket"))
                  .join(counts, "_bucket", "left").na.fill(0))
    sums = full.agg(*[F.sum(f"c{i}").alias(f"s{i}") for i in range(len(domains))]).first()
    ll = F.array(*[F.log((F.col(f"c{i}") + 0.5) / F.lit(float(sums[i] + 0.5 * BUCKETS))) for i in range(len(domains))])
    total = sum(got.values())
    top = spark.range(1).select(F.lit(-1).cast("int").alias("_bucket"),
                                F.array(*[F.log(F.lit(got[d] / total)) for d in domains]).alias("_ll"))
    return domains, staged(full.select("_bucket", ll.alias("_ll")).unionByName(top))


def row_key(id_col: str, text_col: str) -> Column:
    """A key of a document's id and text; repeated rows share it and so are treated alike."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def posteriors(docs: DataFrame, domains: list[str], model: DataFrame, *, key_col: str, text_col: str) -> DataFrame:
    """(key, rows, tokens, post): rows of each key, words of one of them, and its posterior over ``domains`` as an array.

    The log-likelihood of the words counts as if there were tokens / (1 + tokens / SATURATION) of them, so long
    documents stay soft too. Rows that share a key are the same document, each with these words and this posterior.
    """
    k = len(domains)
    prior = F.lit(list(model.where("_bucket = -1").first()["_ll"]))
    table = F.broadcast(model.where("_bucket >= 0").select("_bucket", *[F.col("_ll")[i].alias(f"_l{i}") for i in range(k)]))
    rows = _exploded(docs.select(F.col(key_col).alias("_key"), F.col(text_col).alias("_t")), ["_key"], "_t")
    sums = (rows.join(table, "_bucket").groupBy("_key")
            .agg(F.count("*").alias("tokens"), *[F.sum(f"_l{i}").alias(f"_s{i}") for i in range(k)]))
    wanted = docs.select(F.col(key_col).alias("_key")).groupBy("_key").agg(F.count("*").alias("rows"))
    sums = wanted.join(sums, "_key", "left").withColumn("tokens", F.coalesce((F.col("tokens") / F.col("rows")).cast("long"), F.lit(0)))
    scale = 1.0 / (1.0 + F.col("tokens") / SATURATION) / F.col("rows")
    logit = F.array(*[F.coalesce(F.col(f"_s{i}") * scale, F.lit(0.0)) + prior[i] for i in range(k)])
    scored = sums.select("_key", "rows", "tokens", logit.alias("_z"))
    soft = F.transform("_z", lambda z: F.exp(z - F.array_max("_z")))
    scored = scored.select("_key", "rows", "tokens", soft.alias("_e"))
    norm = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
    return scored.select("_key", "rows", "tokens", F.transform("_e", lambda x: x / norm).alias("post"))


def source_shares(docs: DataFrame, *, key: Column, source_col: str) -> tuple[list[str | None], DataFrame]:
    """(sources, null last; table of ``_key`` and ``sources``: place and share of rows of each source with that key)."""
    rows = staged(docs.select(key.alias("_key"), F.col(source_col).cast("string").alias("_src"))
                  .groupBy("_key", "_src").agg(F.count("*").alias("n")))
    names = [r["_src"] for r in rows.select("_src").distinct().orderBy(F.asc_nulls_last("_src")).collect()]
    table = docs.sparkSession.createDataFrame(list(enumerate(names)), "at int, _name string")
    found = rows.join(F.broadcast(table), F.col("_src").eqNullSafe(F.col("_name")))
    lists = found.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("l"), F.sum("n").alias("all"))
    return names, lists.select("_key", F.transform("l", lambda x: F.struct(
        x["at"].alias("at"), (x["n"] / F.col("all")).alias("share"))).alias("sources"))


def tempered_targets(totals: list[float], power: float = 0.7) -> list[float]:
    """Target totals with shares flattened by ``power``, as small as keeps every domain's rate at 1 or more."""
    have = [max(t, 1e-9) for t in totals]
    weight = [t ** power for t in have]
    scale = max(t / w for t, w in zip(have, weight, strict=True))
    return [w * scale for w in weight]


def weighted_targets(totals: list[float], weights: list[float]) -> list[float]:
    """Target totals in proportion to ``weights`` with the sum of ``totals``."""
    return [sum(totals) * w / sum(weights) for w in weights]


def _step_share(row: DataFrame, move: Column, step: np.ndarray, want: np.ndarray, prices: np.ndarray, damp: float,
                least: float) -> float:
    """Share of ``step`` at which the dual is lowest along it; one aggregation of its slopes at ``CUTS``."""
    w, z, d = F.col("_w"), F.col("_z"), F.col("_d")
    got = row.withColumn("_d", move).agg(
        *[F.sum(w * F.greatest(F.lit(least), z + F.lit(c) * d) * d) for c in CUTS]).first()
    slope = [float(x or 0.0) - float(step @ want) + damp * float((prices + c * step) @ step)
             for x, c in zip(got, CUTS, strict=True)]
    at = next((i for i, v in enumerate(slope) if v <= 0.0), len(CUTS) - 1)
    if at == 0 or slope[at] > 0.0:
        return CUTS[at]
    return CUTS[at] + (CUTS[at - 1] - CUTS[at]) * -slope[at] / (slope[at - 1] - slope[at])


def fit_rates(post: DataFrame, targets=tempered_targets, *, domains: int, sources: int = 0, least: float = 0.0,
              steps: int = STEPS, tolerance: float = TOLERANCE) -> tuple[DataFrame, list[float], list[float]]:
    """(``post`` with ``rate``, expected totals reached, targets) for a stored table of posteriors.

    A document counts as many times as it has ``rows`` (1 where ``post`` lacks that column).
    ``targets`` maps the totals at rate 1 to the wanted totals; with ``sources`` (then
    ``post`` has a column ``sources``) those of the domains and, after them, those of
    the sources, the smaller sum raised to the other. Rates are at least
    ``least`` (0 or more; 1 keeps every document). A Newton step of the prices uses
    the totals and the token masses of pairs of domains, taken of the documents whose
    rate is not cut; a step after which the dual rises again is shortened to where
    it is lowest. Steps end when the totals match, or when they are as near as the
    bound lets them; a remaining gap is logged.
    """
    k = domains + sources
    base = max(1.0, least)
    prices, step = np.zeros(k), np.zeros(k)
    times = F.col("rows") if "rows" in post.columns else F.lit(1)
    want = np.zeros(0)
    vec = F.transform("post", lambda p, i: F.struct(i.alias("i"), p.alias("p")))
    if sources:
        vec = F.concat(vec, F.transform("sources", lambda x: F.struct(
            (x["at"] + F.lit(domains)).alias("i"), x["share"].alias("p"))))
    pairs = F.flatten(F.transform("_v", lambda a, n: F.transform(F.slice("_v", n + 1, k), lambda b: F.struct(
        a["i"].alias("i"), b["i"].alias("j"), a["p"].alias("p"), b["p"].alias("q")))))

    def along(weights: np.ndarray) -> Column:
        table = F.lit([float(x) for x in weights])
        return F.aggregate("_v", F.lit(0.0), lambda a, x: a + x["p"] * F.get(table, x["i"]))

    def measure(at: np.ndarray) -> tuple[DataFrame, np.ndarray, np.ndarray]:
        row = post.select((F.col("tokens").cast("double") * times).alias("_w"), vec.alias("_v"))
        row = row.withColumn("_z", F.lit(base) + along(at))
        # Rates at the bound may rise from it, so they count as not cut.
        live = F.when(F.col("_z") >= least, F.col("_w")).otherwise(0.0)
        sums = (row.select((F.greatest(F.lit(least), "_z") * F.col("_w")).alias("_m"), live.alias("_live"),
                           F.explode(pairs).alias("_p"))
                .groupBy("_p.i", "_p.j").agg(F.sum(F.col("_m") * F.col("_p.p")).alias("m"),
                                             F.sum(F.col("_live") * F.col("_p.p") * F.col("_p.q")).alias("h")).collect())
        totals, mass = np.zeros(k), np.zeros((k, k))
        for r in sums:
            mass[r["i"], r["j"]] = mass[r["j"], r["i"]] = r["h"] or 0.0
            if r["i"] == r["j"]:
                totals[r["i"]] = r["m"] or 0.0
        return row, totals, mass

    row, got, mass = measure(prices)
    parts = [np.array(targets([float(x) for x in g]), dtype=float) for g in (got[:domains], got[domains:]) if len(g)]
    want = np.concatenate([w * (max(x.sum() for x in parts) / max(w.sum(), 1e-300)) for w in parts])
    size = max(float(want.sum()), 1.0)
    damp = DAMPING * size
    best = (float("inf"), prices, got)
    for i in range(steps + 1):
        gap = got - want
        slope = gap + damp * prices
        if float(np.abs(gap).max()) < best[0]:
            best = (float(np.abs(gap).max()), prices, got)
        if np.abs(gap).max() <= tolerance * size or np.abs(slope).max() <= SETTLED * size:
            best = (float(np.abs(gap).max()), prices, got)
            break
        if i == steps:
            log.warning("rates: no end after %d steps", steps)
            break
        step = -np.linalg.solve(mass + damp * np.eye(k), slope)
        there = measure(prices + step)
        if float((there[1] - want + damp * (prices + step)) @ step) > 0.1 * abs(float(slope @ step)):
            step = step * _step_share(row, along(step), step, want, prices, damp, least)
            there = measure(prices + step)
        prices = prices + step
        row, got, mass = there
    off, prices, have = best
    if off > tolerance * size:
        log.warning("rates: largest gap left %.3g of %.3g target tokens", off, size)
    rate = F.greatest(F.lit(least), F.lit(base) + along(prices))
    return post.withColumn("_v", vec).withColumn("rate", F.round(rate, 6)).drop("_v"), [float(x) for x in have], [float(x) for x in want]


def copies(rate: Column, key: Column) -> Column:
    """Whole copies for a rate: its floor, and one more with the chance of its fraction, by a hash of the key."""
    chance = F.pmod(F.xxhash64(key, F.lit("mix")), F.lit(1_000_000)) / F.lit(1_000_000.0)
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def apply_rates(docs: DataFrame, rates: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, each as many times as the rate of its key asks for."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # own names: the table's can't clash with ours
    key = row_key(names[docs.columns.index(id_col)], names[docs.columns.index(text_col)])
    many = rates.select("_key", copies(F.col("rate"), F.col("_key")).alias("_n")).where("_n > 0")
    out = docs.toDF(*names).withColumn("_k", key).join(many, F.col("_k") == F.col("_key"))
    return out.select(*names, F.explode(F.array_repeat(F.lit(1), F.col("_n"))).alias("_copy")).select(*names).toDF(*docs.columns)


def mix(docs: DataFrame, labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        domain_col: str = "domain", targets=tempered_targets,
        least: float = 0.0) -> tuple[DataFrame, list[str], list[float], list[float]]:
    """(rates, domains, totals reached, targets); rates: ``_key``, tokens, post, rate by document key.

    Where ``labelled`` has a column ``source``, the sources in ``docs`` have targets too: totals and targets of the
    domains are followed by those of the sources, in order, null last.
    """
    domains, model = fit_domains(docs, labelled, id_col=id_col, text_col=text_col, domain_col=domain_col)
    keyed = docs.select(row_key(id_col, text_col).alias("_k"), F.col(text_col).alias("_t"))
    post = staged(posteriors(keyed, domains, model, key_col="_k", text_col="_t"))
    names: list[str | None] = []
    if "source" in labelled.columns:
        names, shares = source_shares(docs, key=row_key(id_col, text_col), source_col="source")
        post = staged(post.join(shares, "_key"))
    rates, have, want = fit_rates(post, targets, domains=len(domains), sources=len(names), least=least)
    return rates, domains, have, want
