"""Mixing documents to target weights with soft domain membership, in DataFrame functions only.

1. A multinomial naive Bayes classifier over hashed words is counted on a bounded sample of the
   labelled table (``rows_per_domain`` rows of each domain, by a hash of the id). Words of a text
   aren't independent, so that plain posteriors are too sure: a text's evidence is divided by the
   root of its words, by which chance grows, and one temperature for texts of all lengths is
   chosen by the log loss on a part of the sample that was not counted.
2. Every document's words give domain posteriors.
3. Document rates r solve

       min  1/2 sum_d w_d (sum_i n_i p_id r_i / T - b_d)^2 + l/2 sum_i n_i / T (r_i - 1)^2,  0 <= r <= most

   with n_i tokens, p_id posteriors, T all tokens, b_d target share times the total wanted, and w_d
   one over the domain's present share, which balances the gradient. Projected gradient steps

       r <- min(most, max(0, r - s (sum_d p_id w_d g_d + l (r_i - 1))))

   of spectral length s, the last move's square over its product with the change of gradient, need
   one aggregation each; the steps in between are one column expression over the last written
   rates, which are written again every ``STEPS_A_WRITE`` steps. The search ends when the
   projected gradient's norm is under ``TOLERANCE``, and fails loudly if it isn't within ``STEPS``.

Tokens are counted as UTF-8 bytes over ``TOKEN_BYTES``, the usual rate of sub-word vocabularies, which
holds for scripts without blanks as well. What is collected is bounded: the classifier (``BUCKETS``
rows of counts), the part of the sample that sets the temperature, and numbers per domain and
step. The word table is a literal of fixed size.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import materialize

BUCKETS = 8192
ROWS_PER_DOMAIN = 1500
PSEUDO = 20
LEAST_EVIDENCE = 0.5
TEMPERATURES = [2.0 ** (k / 2) for k in range(-16, 9)]
HELD_OUT = 0.25
TOKEN_BYTES = 4
RIDGE = 1e-2
STEPS = 400
STEPS_A_WRITE = 8
TOLERANCE = 1e-4


def words(text: Column) -> Column:
    """Lower-case words between blanks, newlines, tabs and returns."""
    flat = F.translate(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "\n\t\r", "   ")
    return F.filter(F.split(flat, " "), lambda w: w != "")


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def uniform(key: Column, salt: str) -> Column:
    """Deterministic number in [0, 1) from a key; null counts as a key of its own."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit("")), F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def tokens(text: Column) -> Column:
    """Tokens of a text, by its bytes; null is empty."""
    return F.ceil(F.coalesce(F.octet_length(text.cast("string")), F.lit(0)) / TOKEN_BYTES).cast("bigint")


def fit(docs: DataFrame, labels: DataFrame, domain: Column, id_col: str = "doc_id", text_col: str = "text", rows_per_domain: int = ROWS_PER_DOMAIN) -> tuple[list[str], list[float], list[list[float]]]:
    """(domains, log priors, tempered evidence of each bucket per domain) from labelled documents.

    The evidence is the log ratio of a bucket's count in the domain to the count expected from all
    domains, both raised by ``PSEUDO``, so that rare words say little. Evidence under
    ``LEAST_EVIDENCE`` is chance for the most part, and adds up in long texts: it counts as none.

    ``domain`` is a string column over ``labels``; rows where it is null are left out. Repeated rows
    count each time.
    """
    known = labels.select(F.col(id_col).alias("_id"), domain.alias("domain")).where("_id is not null and domain is not null")
    sizes = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return [], [], []
    share = F.element_at(F.create_map(*[F.lit(x) for d in names for x in (d, min(1.0, rows_per_domain / sizes[d]))]), F.col("domain"))
    # About rows_per_domain short rows of each domain, whatever the size of the labelled table.
    sample = F.broadcast(known.where(uniform(F.col("_id"), "fit") < share))
    text = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(sample, "_id")
    text = materialize(text.select("domain", (uniform(F.col("_id"), "held") < HELD_OUT).alias("held"), F.transform(words(F.col("_t")), bucket).alias("b")), "sample")
    counts = text.where("not held").select("domain", F.explode("b").alias("b")).groupBy("domain", "b").agg(F.count(F.lit(1)).alias("n"))
    table = [[0.0] * BUCKETS for _ in names]
    for r in counts.collect():  # at most BUCKETS rows a domain
        table[names.index(r["domain"])][r["b"]] = float(r["n"])
    total, pooled = sum(sizes.values()), [sum(x) for x in zip(*table)]
    share = [sum(row) / max(1.0, sum(pooled)) for row in table]
    priors = [math.log(sizes[d] / total) for d in names]
    table = [[math.log((x + PSEUDO) / (s * a + PSEUDO)) for x, a in zip(row, pooled)] for row, s in zip(table, share)]
    table = [[x if abs(x) >= LEAST_EVIDENCE else 0.0 for x in row] for row in table]
    if len(names) == 1:
        return names, priors, table
    rest = text.where("held").select("domain", _evidence(F.col("b"), table).alias("s"))
    held = [(names.index(r["domain"]), [0.0, *r["s"]]) for r in rest.collect()]  # HELD_OUT of the sample

    def loss(heat: float) -> float:
        out = 0.0
        for d, evidence in held:
            scores = [p + heat * e for p, e in zip(priors, evidence)]
            top = max(scores)
            out += (top + math.log(sum(math.exp(x - top) for x in scores)) - scores[d]) / sizes[names[d]]
        return out

    heat = min(TEMPERATURES, key=loss) if held else 1.0
    return names, priors, [[heat * x for x in row] for row in table]


def _evidence(buckets: Column, table: list[list[float]]) -> Column:
    """Struct s1, s2, ...: log-likelihood ratio of each further domain against the first, summed over a document's buckets in one pass, over the root of their number."""
    k = len(table)
    rows = [F.from_json(F.lit(json.dumps([round(x - y, 9) for x, y in zip(table[d], table[0])])), "array<double>") for d in range(1, k)]
    zero = F.struct(*[F.lit(0.0).alias(f"s{d}") for d in range(1, k)])
    root = F.sqrt(F.greatest(F.size(buckets), F.lit(1)).cast("double"))
    return F.aggregate(buckets, zero, lambda acc, b: F.struct(*[(acc[f"s{d}"] + F.get(rows[d - 1], b)).alias(f"s{d}") for d in range(1, k)]), lambda acc: F.struct(*[(acc[f"s{d}"] / root).alias(f"s{d}") for d in range(1, k)]))


def posteriors(docs: DataFrame, model: tuple[list[str], list[float], list[list[float]]], text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens and p (array of domain posteriors, in the model's order)."""
    names, priors, table = model
    k = len(names)
    found = docs.withColumn("n_tokens", tokens(F.col(text_col)))
    if k == 1:
        return found.withColumn("p", F.array(F.lit(1.0)))
    found = found.withColumn("_b", F.transform(words(F.col(text_col)), bucket))
    found = found.withColumn("_s", _evidence(F.col("_b"), table)).drop("_b")
    found = found.withColumn("_l", F.array(F.lit(priors[0]), *[F.lit(priors[d]) + F.col(f"_s.s{d}") for d in range(1, k)])).drop("_s")
    found = found.withColumn("_e", F.transform("_l", lambda x: F.exp(x - F.array_max("_l"))))
    norm = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
    return found.withColumn("_n", norm).withColumn("p", F.transform("_e", lambda x: x / F.col("_n"))).drop("_l", "_e", "_n")


def solve_rates(rows: DataFrame, targets: list[float], total: float | None = None, most: float = math.inf, ridge: float = RIDGE, steps: int = STEPS, tolerance: float = TOLERANCE) -> tuple[DataFrame, list[float], list[float]]:
    """``rows`` (n_tokens, p, others) with a ``rate`` of 0 to ``most``; the domain totals wanted and reached.

    ``targets`` are shares per domain (scaled to sum 1). ``total`` is the number of tokens wanted;
    by default the most that needs no domain above its expected supply.
    """
    k = len(targets)
    want = [t / sum(targets) for t in targets]
    base = rows.withColumn("rate", F.lit(min(1.0, most)))
    p = [F.get("p", F.lit(d)) for d in range(k)]
    n = F.col("n_tokens").cast("double")
    have = base.agg(F.sum(n).alias("t"), *[F.sum(n * p[d]).alias(f"m{d}") for d in range(k)], *[F.sum(n * p[a] * p[b]).alias(f"g{a}_{b}") for a in range(k) for b in range(k)]).first()
    all_tokens = float(have["t"] or 0)
    if all_tokens == 0:
        return base, [0.0] * k, [0.0] * k
    mass = [float(have[f"m{d}"]) for d in range(k)]
    if total is None:
        total = min(mass[d] / want[d] for d in range(k) if want[d] > 0)
    wanted = [w * total for w in want]
    goal = [w / all_tokens for w in wanted]
    weight = [1 / max(m / all_tokens, 1e-6) for m in mass]
    # First step: one over the largest row sum of the weighted Gram matrix, a bound of its largest eigenvalue.
    top = max(sum(weight[b] * abs(float(have[f"g{a}_{b}"])) / all_tokens for b in range(k)) for a in range(k))
    step, last = 1 / (top + ridge), None

    def moved(rate: Column, pull: Column, length: float) -> Column:
        return F.least(F.lit(most), F.greatest(F.lit(0.0), rate * F.lit(1 - length * ridge) - F.lit(length) * pull + F.lit(length * ridge)))

    # Each step is a column of its own, so that an expression names the one before instead of holding it many times over.
    now, pull = base, F.lit(0.0)
    rate, before = F.col("rate"), F.col("_before")
    for i in range(steps):
        if i == 0:
            now = now.withColumn("_before", rate)
        now = now.withColumn("_probe", F.lit(0.0) if i == 0 else moved(before, pull, 1.0) - before).withColumn("_move", rate - before)
        got = now.agg(F.sum(n * F.col("_probe") * F.col("_probe")).alias("g"), F.sum(n * F.col("_move") * F.col("_move")).alias("m"), *[F.sum(n * p[d] * rate).alias(f"a{d}") for d in range(k)]).first()
        now = now.drop("_probe", "_move")
        reached = [float(got[f"a{d}"]) for d in range(k)]
        residual = [reached[d] / all_tokens - goal[d] for d in range(k)]
        if i:
            if math.sqrt(float(got["g"]) / all_tokens) <= tolerance:
                return now.drop("_before"), wanted, reached
            length = float(got["m"]) / all_tokens
            bent = sum(w * (x - y) ** 2 for w, x, y in zip(weight, residual, last)) + ridge * length
            step = min(1 / ridge, max(1 / (top + ridge), length / bent)) if bent > 0 else 1 / (top + ridge)
        last = residual
        pull = sum((p[d] * F.lit(weight[d] * residual[d]) for d in range(k)), F.lit(0.0))
        if i % STEPS_A_WRITE == STEPS_A_WRITE - 1:
            now = materialize(now.drop("_before"), "rates")
        now = now.withColumn("_before", rate).withColumn("rate", moved(before, pull, step))
    raise RuntimeError(f"rates did not settle in {steps} steps")


def mix(docs: DataFrame, labelled: DataFrame, labels: DataFrame, domain: Column, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", most: float = math.inf) -> DataFrame:
    """(id_col, n_tokens, p, rate, kept, wanted, reached) of every row of ``docs``.

    ``p`` follows the sorted domain names, as do ``wanted`` and ``reached``, the domains' tokens asked
    for and expected at the rates; domains missing in ``targets`` get none. ``kept`` takes a
    document with probability ``rate`` (at most 1), by a hash of its id: thinning asks for ``most`` 1.
    Null and empty texts have no tokens, the priors as posteriors and a rate that changes no
    total. Repeated rows have the same rate and share their fate. Without labelled rows or targets
    all rates are 1.
    """
    model = fit(labelled, labels, domain, id_col, text_col)
    rows = docs.select(id_col, F.col(text_col).alias("_t"))
    shares = [float(targets.get(d, 0.0)) for d in model[0]]
    wanted = reached = []
    if not model[0] or sum(shares) <= 0:
        out = rows.select(id_col, tokens(F.col("_t")).alias("n_tokens"), F.array(F.lit(1.0)).alias("p"), F.lit(1.0).alias("rate"))
    else:
        soft = materialize(posteriors(rows, model, "_t").select(id_col, "n_tokens", "p"), "posteriors")
        out, wanted, reached = solve_rates(soft, shares, most=most)
    totals = [F.array(*[F.lit(x) for x in t]).cast("array<double>").alias(n) for n, t in (("wanted", wanted), ("reached", reached))]
    return out.withColumn("kept", uniform(F.col(id_col), "mix") < F.col("rate")).select("*", *totals)


def keep_mixed(docs: DataFrame, labels: DataFrame, domain: Column, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that the mixture takes, with all their columns; rows with a null id stay."""
    dropped = mix(docs, docs, labels, domain, targets, id_col, text_col, 1.0).where(~F.col("kept")).select(F.col(id_col).alias("_dropped"))
    return docs.join(dropped, docs[id_col] == dropped["_dropped"], "left_anti")


#: Domains of the labels table, and the token shares that the mixture should have.
TARGETS = {"good": 0.96, "poor": 0.04, "toxic": 0.0}


def label_domain() -> Column:
    """Domain of a row of ``labels``: toxic before quality; null where neither is known."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return mix(docs, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), label_domain(), TARGETS, most=1.0)
