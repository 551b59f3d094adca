"""Soft-membership mixing: document rates whose expected domain totals meet target weights.

A naive Bayes classifier over word, mark and shape features is learned from labelled rows and gives
every document the posterior of each domain.  Features are chosen by the G test; how many, and how far
their evidence is scaled down for being dependent, is what loses least on labelled rows that it did not
learn from.  Rates x from 0 to ``most`` then minimise

    1/2 sum_k c_k (sum_d w_d p_dk x_d - t_k)^2  +  mu/2 sum_d w_d (x_d - 1)^2

with w_d the document's share of all tokens, p_dk its posteriors, t_k the target in the same unit and
1 / c_k = sum_d w_d p_dk^2, so that small domains count as large ones do.  In the inner product
weighted by w, a projected gradient step is

    x_d <- x_d - step (sum_k p_dk c_k r_k + mu (x_d - 1)), cut to its range,   r_k = sum_d w_d p_dk x_d - t_k

so a document's rate follows from its posteriors and the residuals r of all steps.  Each step is one
aggregation over the distinct posteriors; the driver holds one residual a domain and step.
All of it is DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlift.llm.tables import written

#: Labelled rows of each domain that the classifier is learned from, about.
LABELLED = 4000
#: A feature counts if it is in so many learned texts and its G statistic over the domains is as large.
LEAST_TEXTS, LEAST_G = 5, 20.0
#: Numbers of features a domain, those of largest G, and scales of their evidence that are tried.
SIZES = (8, 16, 32, 64)
SCALES = (1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05, 0.02, 0.0)
#: Weight of the prior in every posterior, so none is quite 0.
FLOOR = 1e-3
STEPS = 40
TOLERANCE = 1e-3
PULL = 0.01
#: Posteriors are kept to so many places, so that equal cases meet.
PLACES = 6
#: Stands for the row itself among its features.
ROW = -1
_KEY = ["doc_id", "mix_hash"]


def featured(docs: DataFrame, *kept: str) -> DataFrame:
    """``kept`` columns and ``feature``, a row for the 64-bit hash of each feature of each text and one with ``ROW``.

    Features are the distinct lower-cased words of letters, the distinct runs of other characters,
    and the share of distinct words in eighths.  A text counts once for each.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.split(F.lower(F.regexp_replace(text, r"[^\p{L}\s]+", "")), r"\s+")
    marks = F.split(F.regexp_replace(text, r"[\p{L}\s]+", " "), " ")
    rows = docs.select(*kept, words.alias("words"), F.array_distinct(marks).alias("marks")).withColumn("own", F.array_distinct("words"))
    share = F.floor(8 * F.size("own") / F.size("words")).cast("string")
    rows = rows.select(*kept, F.explode(F.concat("own", "marks", F.array(F.concat(F.lit("share"), share), F.lit("\u0001")))).alias("feature"))
    return rows.where("feature <> ''").select(*kept, F.when(F.col("feature") == "\u0001", F.lit(ROW).cast("long")).otherwise(F.xxhash64("feature")).alias("feature"))


def tokens(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


class Model:
    """Domains in order, their prior, and the log odds of each against the first: of a row, and by feature."""

    def __init__(self, names: list[str], prior: list[float], row: list[float], odds: dict[int, list[float]]):
        self.names, self.prior, self.row, self.odds = names, prior, row, odds

    def table(self, spark) -> DataFrame:
        """(feature, o1, ...), a row for ``ROW`` included; SIZES[-1] rows a domain and one at most."""
        schema = ", ".join(["feature long", *(f"o{k} double" for k in range(1, len(self.names)))])
        return spark.createDataFrame([(f, *o) for f, o in sorted({ROW: self.row, **self.odds}.items())], schema)


def _softmax(odds: list[Column], prior: list[float]) -> list[Column]:
    """Posteriors from log odds against the first domain."""
    scores = [F.lit(0.0), *odds]
    top = F.greatest(*scores) if odds else scores[0]
    powers = [F.exp(F.greatest(s - top, F.lit(-60.0))) for s in scores]
    norm = sum(powers[1:], powers[0])
    return [(x / norm + F.lit(FLOOR * p)) / F.lit(1 + FLOOR) for x, p in zip(powers, prior)]


def _telling(counts: DataFrame, sums: list[int]) -> list[tuple]:
    """(feature, rank, n of each domain) of the features of largest G for the domain they are most frequent in."""
    k, everything = range(len(sums)), float(sum(sums))
    n = [F.col(f"n{i}").cast("double") for i in k]
    all_n = sum(n[1:], n[0])

    def part(have: Column, due: Column) -> Column:
        return F.when(have > 0, have * F.ln(have / due)).otherwise(0.0)

    terms = [part(n[i], all_n * sums[i] / everything) + part(sums[i] - n[i], (everything - all_n) * sums[i] / everything) for i in k if sums[i]]
    share = [n[i] / max(sums[i], 1) for i in k]
    home = F.array_position(F.array(*share), F.array_max(F.array(*share)))
    rated = counts.where(all_n >= LEAST_TEXTS).withColumns({"g": 2 * sum(terms[1:], terms[0]), "home": home}).where(F.col("g") >= LEAST_G)
    first = Window.partitionBy("home").orderBy(F.desc("g"), "feature")
    best = rated.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= SIZES[-1])
    return [(r["feature"], r["rank"], [r[f"n{i}"] for i in k]) for r in best.collect()]  # SIZES[-1] rows a domain


def learn(docs: DataFrame, labelled: DataFrame) -> Model:
    """From ``docs`` (doc_id, text) and ``labelled`` (doc_id, domain).

    About ``LABELLED`` labelled rows of each domain, chosen by a hash of doc_id, are used; that
    bounds what is sent to the tasks.  A fifth of them, by a hash of the text, choose size and scale.
    """
    spark = docs.sparkSession
    labelled = labelled.where("doc_id IS NOT NULL AND domain IS NOT NULL").distinct()
    counts = {r[0]: r[1] for r in labelled.groupBy("domain").count().collect()}  # a row a domain
    names = sorted(counts)
    if not names:
        return Model([], [], [], {})
    prior = [counts[d] / sum(counts.values()) for d in names]
    chance = [min(1.0, LABELLED / counts[d]) for d in names]
    index = F.array_position(F.array(*map(F.lit, names)), F.col("domain")).cast("int")
    share = F.element_at(F.array(*map(F.lit, chance)), index)
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)).select(F.col("doc_id").cast("long").alias("doc_id"), index.alias("domain"))
    texts = docs.join(F.broadcast(chosen), "doc_id").dropDuplicates(["domain", "text"])
    held = F.pmod(F.xxhash64("text", F.lit("held")), F.lit(5)) == 0
    keyed = texts.select("domain", F.xxhash64("text").alias("key"), F.coalesce(held, F.lit(False)).alias("held"), "text")
    rows = written(featured(keyed, "domain", "key", "held"), "mixing-learned")
    each = rows.where("NOT held").groupBy("feature").agg(*(F.count(F.when(F.col("domain") == i + 1, 1)).alias(f"n{i}") for i in range(len(names))))
    learned = each.where(F.col("feature") == ROW).first()
    sums = [learned[f"n{i}"] for i in range(len(names))] if learned else [0] * len(names)
    found = _telling(each.where(F.col("feature") != ROW), sums) if sum(sums) else []

    odds, absent = {}, {}
    for feature, rank, n in found:
        usual = sum(n) / sum(sums)
        has = [(x + usual) / (s + 1) for x, s in zip(n, sums)]
        logit = [math.log(p / (1 - p)) if p < 1 else math.log(2.0 * sum(sums)) for p in has]
        none = [math.log(max(1 - p, 0.5 / sum(sums))) for p in has]
        odds[feature] = rank, [x - logit[0] for x in logit[1:]]
        absent[feature] = [x - none[0] for x in none[1:]]
    base = [math.log(p / prior[0]) for p in prior[1:]]

    def row(size: int) -> list[float]:
        """What a text without any of the features has beside the prior."""
        return [sum(absent[f][i] for f, (rank, _) in odds.items() if rank <= size) for i in range(len(base))]

    size, scale = _chosen(rows, spark, odds, {m: row(m) for m in SIZES}, base, prior, chance)
    return Model(names, prior, [b + scale * r for b, r in zip(base, row(size))], {f: [scale * x for x in o] for f, (rank, o) in odds.items() if rank <= size})


def _chosen(rows: DataFrame, spark, odds: dict, absent: dict, base: list[float], prior: list[float], chance: list[float]) -> tuple[int, float]:
    """Size and scale of least log loss over the held rows, each weighted for what it was chosen from."""
    if not odds or not base:
        return SIZES[0], 0.0
    names = {m: [f"m{m}_{i}" for i in range(len(base))] for m in SIZES}
    schema = ", ".join(["feature long", *(f"{c} double" for m in SIZES for c in names[m])])
    model = [(f, *((x if rank <= m else 0.0) for m in SIZES for x in o)) for f, (rank, o) in odds.items()]
    model.append((ROW, *(x for m in SIZES for x in absent[m])))
    sums = rows.where("held").join(F.broadcast(spark.createDataFrame(model, schema)), "feature").groupBy("domain", "key").agg(*(F.sum(c).alias(c) for m in SIZES for c in names[m]))
    weight = F.element_at(F.array(*(F.lit(1 / c) for c in chance)), F.col("domain"))
    losses = []
    for m in SIZES:
        for scale in SCALES:
            posterior = _softmax([F.lit(b) + scale * F.col(c) for b, c in zip(base, names[m])], prior)
            losses.append(F.sum(-weight * F.ln(F.element_at(F.array(*posterior), F.col("domain")))))
    met = list(sums.agg(*losses).first())  # one row
    tried = [(m, scale) for m in SIZES for scale in SCALES]
    if met[0] is None:  # no held row
        return SIZES[0], SCALES[len(SCALES) // 2]
    return tried[met.index(min(met))]


def posteriors(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, mix_hash, mix_tokens, mix_posteriors, rows) of the distinct rows of (doc_id, mix_hash, mix_tokens, text)."""
    scores = [f"o{k}" for k in range(1, len(model.names))]
    found = featured(docs, *_KEY, "mix_tokens").join(F.broadcast(model.table(docs.sparkSession)), "feature")
    found = found.groupBy(*_KEY).agg(F.max("mix_tokens").alias("mix_tokens"), F.count(F.when(F.col("feature") == ROW, 1)).alias("rows"), *(F.sum(s).alias(s) for s in scores))
    each = _softmax([F.col(s) / F.col("rows") for s in scores], model.prior)
    return found.select(*_KEY, "mix_tokens", F.array(*(F.round(x, PLACES) for x in each)).alias("mix_posteriors"), "rows")


def rate(p: Column, pushes: list[list[float]], step: float, pull: float, most: float | None = None) -> Column:
    """A document's rate after all steps, from its posteriors and c_k r_k of each step."""
    if not pushes:
        return F.lit(1.0)
    history = F.array(*(F.array(*(F.lit(float(r)) for r in rs)) for rs in pushes))

    def stepped(x: Column, rs: Column) -> Column:
        pushed = F.aggregate(F.zip_with(p, rs, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        moved = F.greatest(F.lit(0.0), x - F.lit(step) * (pushed + F.lit(pull) * (x - 1.0)))
        return moved if most is None else F.least(moved, F.lit(float(most)))

    return F.aggregate(history, F.lit(1.0), stepped)


def fit(cells: DataFrame, weights: list[float], total: float | None = None, steps: int = STEPS, pull: float = PULL, most: float | None = None) -> tuple[list[list[float]], float]:
    """c_k r_k of all steps and the step size, for ``cells`` (p, n): posteriors and the tokens that have them.

    ``weights`` are the domains' shares of the mix, ``total`` its tokens; by default as many as keep
    all expected tokens of the domain with the largest weight.
    """
    k = len(weights)
    part = [F.element_at("p", i + 1) for i in range(k)]
    sums = cells.agg(F.sum("n").alias("n"), *(F.sum(F.col("n") * part[i]).alias(f"d{i}") for i in range(k)), *(F.sum(F.col("n") * part[i] * part[i]).alias(f"s{i}") for i in range(k))).first()
    everything = float(sums["n"] or 0)
    if not everything or not sum(weights):
        return [], 1.0
    weights = [w / sum(weights) for w in weights]
    largest = max(range(k), key=lambda i: weights[i])
    total = float(sums[f"d{largest}"]) / weights[largest] if total is None else total
    targets = [w * total / everything for w in weights]
    scale = [everything / float(sums[f"s{i}"]) if sums[f"s{i}"] else 0.0 for i in range(k)]
    step = 1.0 / (sum(s > 0 for s in scale) + pull)
    pushes: list[list[float]] = []
    for _ in range(steps):
        met = cells.withColumn("x", rate(F.col("p"), pushes, step, pull, most)).agg(*(F.sum(F.col("n") * F.col("x") * part[i]) for i in range(k))).first()
        residual = [float(m) / everything - t for m, t in zip(met, targets)]
        if max(map(abs, residual)) < TOLERANCE:
            break
        pushes.append([c * r for c, r in zip(scale, residual)])
    return pushes, step


def mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], total: float | None = None, most: float | None = None) -> DataFrame:
    """(doc_id, mix_hash, mix_tokens, mix_posteriors, rows, mix_rate, mix_targets, mix_attained) of the distinct (doc_id, text) of ``docs``.

    ``mix_hash`` is the xxhash64 of the text.  ``labelled`` has doc_id and domain; domains that
    ``weights`` leaves out have target 0.  ``most`` bounds the rates, 1 where documents are kept or dropped.
    Arrays are by domain in order; targets and attained are shares of the mix, the same in all rows, the
    latter expected from posteriors and rates.  They differ where no rates meet the targets: a domain that
    the features cannot tell keeps a share.  Without labelled rows, or without tokens, rates are 1 and
    shares null.  A null or empty text has no tokens.  Repeated rows are one row that counts ``rows`` times.
    """
    model = learn(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labelled)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("mix_hash"), tokens(F.col("text")).alias("mix_tokens"), "text")
    unknown = F.lit(None).cast("array<double>")
    if not model.names:
        found = keyed.groupBy(*_KEY).agg(F.max("mix_tokens").alias("mix_tokens"), F.count("*").alias("rows"))
        return found.select(*_KEY, "mix_tokens", F.array().cast("array<double>").alias("mix_posteriors"), "rows", F.lit(1.0).alias("mix_rate"), unknown.alias("mix_targets"), unknown.alias("mix_attained"))
    scored = written(posteriors(keyed, model), "mixing-posteriors")
    cells = written(scored.groupBy(F.col("mix_posteriors").alias("p")).agg(F.sum(F.col("mix_tokens") * F.col("rows")).alias("n")), "mixing-cells")
    wanted = [weights.get(d, 0.0) for d in model.names]
    pushes, step = fit(cells, wanted, total, most=most)
    got = cells.withColumn("x", rate(F.col("p"), pushes, step, PULL, most)).agg(*(F.sum(F.col("n") * F.col("x") * F.element_at("p", i + 1)) for i in range(len(wanted)))).first()

    def shares(values: list) -> Column:
        whole = sum(v or 0 for v in values)
        return F.array(*(F.lit(float(v) / whole) for v in values)) if whole else unknown

    return scored.withColumns({"mix_rate": rate(F.col("mix_posteriors"), pushes, step, PULL, most), "mix_targets": shares(wanted) if got[0] is not None else unknown, "mix_attained": shares(list(got))})


def domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a table with quality and toxic flags: toxic, clean or poor."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain"))
