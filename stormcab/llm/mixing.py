"""Mixing sources to target weights (operator 5): raking, then sampling by calibrated probabilities.

Documents are counted into cells by source, language and topic.  The probability of a cell is
min(1, factor of its source x factor of its language x factor of its topic).  Iterative proportional
fitting sets the factors of one dimension after another so that the expected tokens meet its target marginals,
until all of them do (`TOLERANCE`) or `SWEEPS` are over.  Cells at 1 are fixed and the others of the same value take
what is left, so nothing is lost at the bound.  A document stays if a hash of its id, a number from 0 to 1, lies
below its cell's probability: expected tokens meet the budget and the marginals.

A target may ask for more tokens than a value has.  It then gets all of them, and the rest of the budget
goes to the other values in proportion to their targets (`reachable`), before the raking.

Scale: counting combines before the shuffle, so a source with a third of all
rows is a few cells from then on; each sweep is one sum over the sources' rows.  Languages and topics are
small dimensions: their grid is on the driver, of at most `GRID` cells, and more of them are an error.  Sources are
not.  Cells go back to the rows by a join on the cell that broadcasts the at most 1,024 largest cells and shuffles the rest.

Default targets: shares in proportion to the square root of the tokens, which
moves weight from the large to the small.  Any targets can be given instead, as a frame
(value, share) for each dimension; a value without a target gets none, and its documents have probability 0.
The given tables have no topic; `surface_class`, a class of what the text looks like, stands in for it.

Defined results: a null source or language is the value `(none)`; a text without words weighs
nothing and has probability 0; rows with one id are sampled alike; an empty table gives no row; other columns are not read,
and columns named like those of the result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, narrowed, row_of, saved, split_join, table

DIMENSIONS = ("source", "lang", "topic")
SWEEPS, KEEP, SEED = 20, 0.8, 17
TOLERANCE = 1e-12     # of the budget, the largest gap of a marginal
NEWTON = 8            # steps to a source's factor
ONE = 1 - 1e-9        # a cell from here on counts as one at 1, whatever the order of its factors' product
GRID = 100_000        # languages x topics

# The surface classes, the first whose pattern is found in the text.
TOPICS = (("legal", "[Ll]icen[cs]e|[Cc]opyright"), ("contact", "@"), ("figures", "[0-9]"), ("sections", "\n"))
OTHER_TOPIC = "line"


def surface_class(text: Column) -> Column:
    """Surface class of a text by the patterns of `TOPICS`."""
    out = None
    for name, pattern in TOPICS:
        out = F.when(text.rlike(pattern), name) if out is None else out.when(text.rlike(pattern), name)
    return out.otherwise(OTHER_TOPIC)


def uniform(id_: Column) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    digits = F.substring(F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(f":{SEED}"))), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def root_targets(cells: DataFrame, dimension: str) -> DataFrame:
    """(value, share): shares in proportion to the square root of each value's tokens."""
    roots = cells.groupBy(F.col(dimension).alias("value")).agg(F.sqrt(F.sum("tokens").cast("double")).alias("root"))
    return roots.crossJoin(roots.agg(F.sum("root").alias("all"))).select("value", (F.col("root") / F.col("all")).alias("share"))


def reachable(cells: DataFrame, dimension: str, wanted: DataFrame, budget: float) -> DataFrame:
    """(value, tokens, target): targets in tokens that sum to the budget and that no value falls short of.

    Values that have fewer tokens than their share give all; what they lack goes to the others in proportion,
    until no more fall short."""
    values = saved(cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("tokens"))
                   .join(wanted.select("value", F.col("share").cast("double").alias("share")), "value", "left")
                   .withColumn("share", F.coalesce("share", F.lit(0.0))))
    scale, short = budget, -1
    while True:
        falls_short = (F.col("share") > 0) & (F.lit(float(scale)) * F.col("share") >= F.col("tokens"))
        r = values.agg(F.count_if(falls_short).alias("n"), F.coalesce(F.sum(F.when(falls_short, F.col("tokens"))), F.lit(0)).alias("held"),
                       F.coalesce(F.sum(F.when(~falls_short, F.col("share"))), F.lit(0.0)).alias("rest")).first()
        if r.n == short or r.rest <= 0:
            break
        scale, short = (budget - float(r.held)) / r.rest, r.n
    return values.select("value", "tokens", F.when(falls_short, F.col("tokens").cast("double")).otherwise(F.lit(float(scale)) * F.col("share")).alias("target"))


def moved(factor: float, target: float, fixed: float, free: float) -> float:
    """A factor that brings a value to its target: `fixed` tokens of cells at 1, `free` of the others per unit of factor."""
    if free > 0 and target > fixed:
        return (target - fixed) / free
    return factor * target / max(fixed + factor * free, 1e-300)


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, sweeps: int = SWEEPS) -> DataFrame:
    """`cells` (source, lang, topic, n, tokens) with `chance`, the probability of each cell, and the
    target of its source, language and topic in tokens.

    The cells of a source are one row, so its factor needs no shuffle; one sum over all sources by language and
    topic then gives the other two factors.  That grid, and nothing that grows with the sources, is on the driver."""
    wanted = {d: (targets or {}).get(d) for d in DIMENSIONS}
    wanted = {d: root_targets(cells, d) if w is None else w for d, w in wanted.items()}
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    # a dimension may target a part of the values only
    held = [float(cells.join(w.where("share > 0").select(F.col("value").alias(d)), d, "left_semi").agg(F.sum("tokens")).first()[0] or 0) for d, w in wanted.items()]
    budget = min(keep * total, total, *held)
    goal = {d: reachable(cells, d, wanted[d], budget) for d in DIMENSIONS}
    lang_goal, topic_goal = ({r.value: r.target for r in goal[d].limit(GRID + 1).collect()} for d in ("lang", "topic"))
    if len(lang_goal) * len(topic_goal) > GRID:
        raise ValueError(f"{len(lang_goal)} languages x {len(topic_goal)} topics: at most {GRID} cells")
    rows = saved(cells.groupBy("source").agg(F.collect_list(F.struct("lang", "topic", "n", "tokens")).alias("cells"))  # languages x topics
                 .join(goal["source"].select(F.col("value").alias("source"), F.col("target").alias("target_source")), "source"))
    rows = narrowed(rows, rows.agg(F.sum(F.size("cells"))).first()[0] or 0)
    lang_factor, topic_factor = dict.fromkeys(lang_goal, 1.0), dict.fromkeys(topic_goal, 1.0)

    def looked_up(factor: dict[str, float], key: Column) -> Column:
        return F.create_map(*(F.lit(x) for pair in factor.items() for x in pair))[key] if factor else F.lit(None).cast("double")

    def scaled() -> DataFrame:
        """One row for each cell: `x`, the product of its language's and topic's factors, and `a`, its source's factor."""
        given = rows.withColumn("cells", F.transform("cells", lambda c: c.withField("x", looked_up(lang_factor, c["lang"]) * looked_up(topic_factor, c["topic"]))))

        def over(what):
            return F.aggregate("cells", F.lit(0.0), lambda s, c: s + what(c))

        first = F.col("target_source") / F.greatest(over(lambda c: c["tokens"] * c["x"]), F.lit(1e-300))

        def step(a: Column, _: Column) -> Column:
            fixed = over(lambda c: F.when(a * c["x"] >= ONE, c["tokens"].cast("double")).otherwise(0.0))
            free = over(lambda c: F.when(a * c["x"] >= ONE, 0.0).otherwise(c["tokens"] * c["x"]))
            return F.when((free > 0) & (F.col("target_source") > fixed), (F.col("target_source") - fixed) / free).otherwise(
                a * F.col("target_source") / F.greatest(fixed + a * free, F.lit(1e-300)))

        factor = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON)), first, step)
        return given.select("source", "target_source", factor.alias("a"), F.explode("cells").alias("c")).select("source", "target_source", "c.*", "a")

    for _ in range(sweeps if lang_goal else 0):
        last = scaled()
        at_one = F.col("a") * F.col("x") >= ONE
        sums = last.groupBy("lang", "topic").agg(F.sum(F.when(at_one, F.col("tokens").cast("double")).otherwise(0.0)).alias("fixed"),
                                                 F.sum(F.when(at_one, 0.0).otherwise(F.col("a") * F.col("tokens"))).alias("free")).collect()  # languages x topics
        gap = 0.0
        for factor, other, aim, of in ((lang_factor, topic_factor, lang_goal, 0), (topic_factor, lang_factor, topic_goal, 1)):
            fixed, free = dict.fromkeys(aim, 0.0), dict.fromkeys(aim, 0.0)
            for r in sums:
                v, o = (r.lang, r.topic) if of == 0 else (r.topic, r.lang)
                fixed[v] += r.fixed
                free[v] += r.free * other[o]
            for v in aim:
                gap = max(gap, abs(fixed[v] + factor[v] * free[v] - aim[v]))
                factor[v] = moved(factor[v], aim[v], fixed[v], free[v])
        if gap <= TOLERANCE * budget:
            break
    if not lang_goal:
        return rows.select("source", F.lit("").alias("lang"), F.lit("").alias("topic"), F.lit(0).alias("n"), F.lit(0).alias("tokens"), F.lit(0.0).alias("chance")).limit(0)
    last = scaled()
    return last.select("source", "lang", "topic", "n", "tokens", "target_source", looked_up(lang_goal, F.col("lang")).alias("target_lang"),
                       looked_up(topic_goal, F.col("topic")).alias("target_topic"),
                       F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("a") * F.col("x"))).otherwise(0.0).alias("chance"))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP) -> DataFrame:
    """(doc_id, row, source, lang, topic, n_tokens, probability, sampled) for every row of `docs`; the
    budget is `keep` of all tokens."""
    rows = saved(docs.select("doc_id", row_of("text"), "source", "lang", surface_class(F.coalesce("text", F.lit(""))).alias("topic"),
                             F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"))
                 .withColumn("cell", F.struct(*(F.coalesce(d, F.lit("(none)")).alias(d) for d in DIMENSIONS))))
    counted = saved(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens")).select("cell.*", "n", "tokens"))
    counted = narrowed(counted, counted.count())
    chances = saved(rake(counted, targets, keep).select(F.struct(*DIMENSIONS).alias("cell"), "n", "chance"))
    found = split_join(rows, chances, "cell", "n")
    probability = F.when(F.col("n_tokens") > 0, F.col("chance")).otherwise(0.0)
    return (found.withColumn("probability", probability).withColumn("sampled", uniform(F.col("doc_id")) < F.col("probability"))
            .select("doc_id", "row", "source", "lang", "topic", "n_tokens", "probability", "sampled"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated probability and sampling decision of every document."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "sampled")


def _target_sql(d: str) -> str:
    """Reachable targets of a dimension: values that fall short give all, round by round."""
    steps = [f"v_{d}_0 AS (SELECT {d}, tokens, root / sum(root) OVER () AS share, budget AS scale FROM (SELECT {d}, sum(tokens)::DOUBLE AS tokens, sqrt(sum(tokens)::DOUBLE) AS root FROM cells GROUP BY {d}), total)"]
    for k in range(6):
        short = "share > 0 AND scale * share >= tokens"
        steps.append(f"v_{d}_{k + 1} AS (SELECT {d}, tokens, share, CASE WHEN rest > 0 THEN (budget - held) / rest ELSE scale END AS scale FROM (SELECT *, "
                     f"sum(CASE WHEN {short} THEN tokens ELSE 0 END) OVER () AS held, sum(CASE WHEN {short} THEN 0 ELSE share END) OVER () AS rest FROM v_{d}_{k}), total)")
    return ",\n".join([*steps, f"t_{d} AS (SELECT {d}, CASE WHEN share > 0 AND scale * share >= tokens THEN tokens ELSE scale * share END AS target_{d} FROM v_{d}_6)"])


def oracle_sql() -> str:
    """The same in DuckDB, targets, sweeps and steps written out; `f_source`, `f_lang`, `f_topic` are the factors."""
    topic = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in TOPICS)
    steps, previous, k = [], "c0", 0

    def sums(d: str, value: str) -> str:
        return f"sum({value}) OVER (PARTITION BY {d})"

    def step(new: str) -> None:
        nonlocal previous, k
        steps.append(f"c{k + 1} AS ({new.format(previous=previous)})")
        previous, k = f"c{k + 1}", k + 1

    def newton(d: str, others: str) -> str:
        f = f"f_{d}"
        fixed = sums(d, f"CASE WHEN f_source * f_lang * f_topic >= {ONE} THEN tokens ELSE 0 END") if d == "source" else sums(d, "fixed")
        free = sums(d, f"CASE WHEN f_source * f_lang * f_topic >= {ONE} THEN 0 ELSE tokens * {others} END") if d == "source" else sums(d, f"free * {others}")
        return (f"SELECT * EXCLUDE (a, b) REPLACE (CASE WHEN b > 0 AND target_{d} > a THEN (target_{d} - a) / b ELSE {f} * target_{d} / greatest(a + {f} * b, 1e-300) END AS {f}) "
                f"FROM (SELECT *, {fixed} AS a, {free} AS b FROM {{previous}})")

    for sweep in range(SWEEPS + 1):
        step(f"SELECT * REPLACE (target_source / greatest({sums('source', 'tokens * f_lang * f_topic')}, 1e-300) AS f_source) FROM {{previous}}")
        for _ in range(NEWTON):
            step(newton("source", "f_lang * f_topic"))
        if sweep < SWEEPS:  # cells at 1 as they are before the languages' factors change
            step(f"SELECT * REPLACE (CASE WHEN f_source * f_lang * f_topic >= {ONE} THEN tokens ELSE 0 END AS fixed, CASE WHEN f_source * f_lang * f_topic >= {ONE} THEN 0 ELSE tokens * f_source END AS free) FROM {{previous}}")
            step(newton("lang", "f_topic"))
            step(newton("topic", "f_lang"))
    materialized = ",\n".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)
    return f"""
WITH d AS (
  SELECT doc_id, source, lang, coalesce(source, '(none)') AS cs, coalesce(lang, '(none)') AS cl,
         CASE {topic} ELSE '{OTHER_TOPIC}' END AS topic, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n_tokens
  FROM documents),
cells AS MATERIALIZED (SELECT cs AS source, cl AS lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL),
total AS MATERIALIZED (SELECT {KEEP} * sum(tokens) AS budget FROM cells),
{", ".join(map(_target_sql, DIMENSIONS))},
c0 AS MATERIALIZED (SELECT cells.*, target_source, target_lang, target_topic, 1.0::DOUBLE AS f_source, 1.0::DOUBLE AS f_lang, 1.0::DOUBLE AS f_topic, 0.0::DOUBLE AS fixed, 0.0::DOUBLE AS free
       FROM cells JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic)),
{materialized},
chance AS (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN least(1.0, f_source * f_lang * f_topic) ELSE 0 END AS p FROM {previous})
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(CASE WHEN d.n_tokens > 0 THEN p ELSE 0 END, 6)::DOUBLE AS probability,
       ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || ':{SEED}'), 1, 13))::BIGINT / {float(1 << 52)} < CASE WHEN d.n_tokens > 0 THEN p ELSE 0 END AS sampled
FROM d JOIN chance ON d.cs = chance.source AND d.cl = chance.lang AND d.topic = chance.topic
"""
