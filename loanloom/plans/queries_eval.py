"""Queries for ranking, metrics, ensembles and submission rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.operators import ensemble, metrics
from loanloom.operators.ordered import percent_rank_in_group
from loanloom.plans.catalog import query
from loanloom.plans.loanview import long_scores, scored_rows, test_rows, train_rows
from loanloom.schema import ID_COL, TARGET_COL
from loanloom.session import materialize
from loanloom.sources import submission

MODELS = ["s1", "s2", "s3", "s4"]


def _auc_sql(source, keys, score="score", name="roc_auc", having=""):
    """Exact AUC by average ranks, per key list."""
    by = ", ".join(keys)
    part = f"PARTITION BY {by}" if by else ""
    tie = f"PARTITION BY {by + ', ' if by else ''}{score}"
    group = f"GROUP BY {by}" if by else ""
    return f"""
ranked AS (SELECT *, rank() OVER ({part} ORDER BY {score}) + (count(*) OVER ({tie}) - 1) / 2.0::double AS r
  FROM {source}),
aucs AS (SELECT {by + ', ' if by else ''}count(*) AS n, cast(sum(Target) as bigint) AS positives,
  (sum(case when Target = 1 then r else 0 end) - sum(Target) * (sum(Target) + 1) / 2.0::double)
  / (sum(Target) * 1.0::double * sum(1 - Target)) AS {name} FROM ranked {group} {having})"""


# --- ranking -----------------------------------------------------------------

@query("g01_rank_in_group", """
SELECT event_id, event_type, case when value is not null then
  (rank() OVER (PARTITION BY event_type ORDER BY value NULLS LAST)
   + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0::double)
  / count(value) OVER (PARTITION BY event_type) end AS value_rank FROM events""", prefix=False)
def rank_in_group(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type", "value")
    return percent_rank_in_group(events, "value", ["event_type"], "value_rank").drop("value")


@query("g02_global_rank", """
SELECT ID, (rank() OVER (ORDER BY s3) + (count(*) OVER (PARTITION BY s3) - 1) / 2.0::double)
  / count(*) OVER () AS pct_rank FROM scored""")
def global_rank(spark, sf):
    return percent_rank_in_group(scored_rows(spark, sf, ["s3"]), "s3", [], "pct_rank").select(
        "ID", "pct_rank")


_FOLD_AUCS = ("tf AS (SELECT l.*, fold_id FROM longs l JOIN folds USING (ID)),"
              + _auc_sql("tf", ["model", "fold_id"]))


def _fold_scores(spark, sf):
    from loanloom.operators.folds import make_folds

    train = train_rows(spark, sf, ["ID", "Target"])
    return materialize(long_scores(spark, sf).join(make_folds(train), "ID"))


@query("g03_model_ranking", f"{_FOLD_AUCS} SELECT model, round(avg(roc_auc), 8) AS mean_auc FROM aucs GROUP BY model")
def model_ranking(spark, sf):
    per_model = metrics.fold_aucs(_fold_scores(spark, sf))
    return metrics.ranked_models(per_model).select("model", F.round("mean_auc", 8).alias("mean_auc"))


@query("g04_best_model", _auc_sql("longs", ["model"]) + """
SELECT model, round(roc_auc, 8) AS roc_auc FROM aucs ORDER BY roc_auc DESC, model LIMIT 1""")
def best_model(spark, sf):
    return metrics.best_model(metrics.roc_auc(long_scores(spark, sf), keys=["model"])).select(
        "model", F.round("roc_auc", 8).alias("roc_auc"))


# --- metrics -----------------------------------------------------------------

@query("h01_roc_auc", _auc_sql("longs", ["model"]) + """
SELECT model, round(roc_auc, 8) AS roc_auc, n, positives FROM aucs""")
def roc_auc(spark, sf):
    return metrics.roc_auc(long_scores(spark, sf), keys=["model"]).withColumn(
        "roc_auc", F.round("roc_auc", 8))


@query("h01_document_auc", """
WITH ld AS (SELECT toxic AS Target, cast(n_chars as double) AS score, lang FROM labels JOIN documents USING (doc_id)),
""" + _auc_sql("ld", ["lang"]).strip() + " SELECT lang, round(case when isfinite(roc_auc) then roc_auc end, 8) AS roc_auc,"
       " n, positives FROM aucs", prefix=False)
def document_auc(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "n_chars")
    rows = labels.join(docs, "doc_id").select(
        F.col("toxic").alias("Target"), F.col("n_chars").cast("double").alias("score"), "lang")
    return metrics.roc_auc(rows, keys=["lang"]).withColumn("roc_auc", F.round("roc_auc", 8))


_CURVE = """
cells AS (SELECT model, score, count(*) AS n, sum(Target) AS pos FROM longs GROUP BY model, score),
cum AS (SELECT *, sum(n) OVER w AS flagged, sum(pos) OVER w AS tp,
  sum(n) OVER (PARTITION BY model) AS all_n, sum(pos) OVER (PARTITION BY model) AS all_pos
  FROM cells WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
curve AS (SELECT *, flagged - tp AS fp, tp * 1.0::double / flagged AS p, tp * 1.0::double / all_pos AS r
  FROM cum)"""


@query("h02_average_precision", f"{_CURVE} SELECT model, round(sum(pos * 1.0::double / all_pos * p), 8) AS pr_auc"
       " FROM curve GROUP BY model")
def average_precision(spark, sf):
    return metrics.average_precision(long_scores(spark, sf), keys=["model"]).withColumn(
        "pr_auc", F.round("pr_auc", 8))


_FLAT = """
cells AS (SELECT model, count(*) FILTER (Target = 1 and score >= {t}) AS tp,
  count(*) FILTER (Target = 0 and score >= {t}) AS fp, count(*) FILTER (Target = 1 and score < {t}) AS fn,
  count(*) FILTER (Target = 0 and score < {t}) AS tn FROM longs GROUP BY model),
flat AS (SELECT model, (tp + tn) * 1.0::double / (tp + tn + fp + fn) AS accuracy,
  coalesce(2.0::double * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
  coalesce(1.0::double * tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(1.0::double * tp / nullif(tp + fn, 0), 0) AS recall FROM cells)"""


def _flat_metric(name, metric, threshold):
    @query(name, f"{_FLAT.format(t=threshold)} SELECT model, round({metric}, 8) AS {metric} FROM flat")
    def run(spark, sf):
        got = metrics.threshold_metrics(long_scores(spark, sf), keys=["model"], threshold=threshold)
        return got.select("model", F.round(metric, 8).alias(metric))

    return run


_flat_metric("h03_accuracy", "accuracy", 0.5)
_flat_metric("h04_f1", "f1", 0.5)
_flat_metric("h05_precision", "precision", 0.5)
_flat_metric("h06_recall", "recall", 0.99)


@query("h07_evaluate", _auc_sql("longs", ["model"]) + ","
       + _CURVE.replace("cells", "dcells") + f", ap AS (SELECT model, sum(pos * 1.0::double / all_pos * p) AS pr_auc"
       f" FROM curve GROUP BY model), {_FLAT.format(t=0.5)}"
       " SELECT model, round(roc_auc, 8) AS roc_auc, round(pr_auc, 8) AS pr_auc, round(accuracy, 8) AS accuracy,"
       " round(f1, 8) AS f1, round(precision, 8) AS precision, round(recall, 8) AS recall,"
       " 0.5::double AS threshold FROM aucs JOIN ap USING (model) JOIN flat USING (model)")
def evaluate(spark, sf):
    got = metrics.evaluate(long_scores(spark, sf))
    rounded = ["roc_auc", "pr_auc", "accuracy", "f1", "precision", "recall"]
    return got.withColumns({c: F.round(c, 8) for c in rounded})


@query("h08_pr_curve", f"{_CURVE} SELECT model, score AS threshold, cast(tp as bigint) AS tp, cast(fp as bigint) AS fp,"
       " round(p, 8) AS precision, round(r, 8) AS recall FROM curve")
def pr_curve(spark, sf):
    got = metrics.curve_points(long_scores(spark, sf), keys=["model"])
    return got.select("model", "threshold", "tp", "fp", F.round("precision", 8).alias("precision"),
                      F.round("recall", 8).alias("recall"))


@query("h09_best_threshold", f"""{_CURVE}, f AS (SELECT model, score, 2.0::double * p * r / (p + r + 1e-8::double) AS f1
  FROM curve)
SELECT model, threshold, round(f1, 8) AS f1 FROM (SELECT model, score AS threshold, f1,
  row_number() OVER (PARTITION BY model ORDER BY f1 DESC, score) AS rn FROM f) WHERE rn = 1""")
def best_threshold(spark, sf):
    return metrics.best_threshold(long_scores(spark, sf), keys=["model"]).withColumn(
        "f1", F.round("f1", 8))


@query("h10_roc_curve", f"{_CURVE} SELECT model, score AS threshold, round(fp * 1.0::double / (all_n - all_pos), 8)"
       " AS fpr, round(r, 8) AS tpr FROM curve")
def roc_curve(spark, sf):
    got = metrics.curve_points(long_scores(spark, sf), keys=["model"])
    return got.select("model", "threshold", F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"))


@query("h11_calibration", """
o AS (SELECT s3, row_number() OVER (ORDER BY s3, ID) - 1 AS i, count(*) OVER () AS n FROM scored),
e AS (SELECT q, (q * (n - 1)) // 15 AS lo, least((q * (n - 1)) // 15 + 1, n - 1) AS hi,
  ((q * (n - 1)) % 15) / 15.0::double AS part FROM range(1, 15) t(q), (SELECT count(*) AS n FROM scored)),
edges AS (SELECT q, a.s3 + (b.s3 - a.s3) * part AS edge FROM e JOIN o a ON a.i = lo JOIN o b ON b.i = hi),
binned AS (SELECT s3, Target, (SELECT count(*) FROM edges WHERE edge < s3) AS bin FROM scored)
SELECT cast(bin as int) AS bin, count(*) AS n, round(avg(s3), 8) AS mean_score, round(avg(Target), 8)
  AS positive_rate FROM binned GROUP BY bin""")
def calibration(spark, sf):
    rows = scored_rows(spark, sf, ["s3"])
    return metrics.calibration_curve(rows, score="s3").withColumns(
        {"mean_score": F.round("mean_score", 8), "positive_rate": F.round("positive_rate", 8)})


@query("h12_confusion_matrix", """
SELECT a.v AS actual, p.v AS predicted, count(s1) AS n FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) p(v)
LEFT JOIN scored ON Target = a.v AND (case when s1 >= 0.5 then 1 else 0 end) = p.v GROUP BY 1, 2""")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(scored_rows(spark, sf, ["s1"]), score="s1")


@query("h13_classification_report", """
c AS (SELECT count(*) FILTER (Target = 1 and s1 >= 0.5) * 1.0::double AS tp, count(*) FILTER (Target = 0 and s1 >= 0.5)
  * 1.0::double AS fp, count(*) FILTER (Target = 1 and s1 < 0.5) * 1.0::double AS fn,
  count(*) FILTER (Target = 0 and s1 < 0.5) * 1.0::double AS tn FROM scored),
per AS (SELECT '0' AS row, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, 2 * tn / (2 * tn + fn + fp) AS f1,
  tn + fp AS support FROM c UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn
  FROM c),
rep AS (SELECT * FROM per UNION ALL
  SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn),
    (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM c UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM per)
SELECT row, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1,
  cast(support as bigint) AS support FROM rep""")
def classification_report(spark, sf):
    got = metrics.classification_report(scored_rows(spark, sf, ["s1"]), score="s1")
    return got.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


@query("h14_segment_auc", _auc_sql("(SELECT province, Target, s3 AS score FROM scored WHERE province IS NOT NULL)",
                                   ["province"], having="HAVING sum(Target) >= 5 AND sum(1 - Target) >= 5")
       + " SELECT province, n, round(roc_auc, 8) AS roc_auc FROM aucs")
def segment_auc(spark, sf):
    rows = scored_rows(spark, sf, ["s3"], ["province"])
    return metrics.segment_auc(rows, "province", score="s3").withColumn("roc_auc", F.round("roc_auc", 8))


@query("h14_rate_band_auc", _auc_sql(
    "(SELECT case when coalesce(annual_rate_pct, 0) < 40 then 'Bank (<40%)' else 'MFI (>=40%)' end AS band, Target,"
    " s3 AS score FROM scored)", ["band"], having="HAVING sum(Target) >= 5")
       + " SELECT band, n, round(roc_auc, 8) AS roc_auc FROM aucs")
def rate_band_auc(spark, sf):
    rows = scored_rows(spark, sf, ["s3"], ["annual_rate_pct"]).withColumn("band", metrics.rate_band())
    return metrics.segment_auc(rows, "band", score="s3", min_neg=0).withColumn(
        "roc_auc", F.round("roc_auc", 8))


@query("h15_fold_aucs", f"{_FOLD_AUCS} SELECT model, round(avg(roc_auc), 8) AS mean_auc,"
       " round(stddev_pop(roc_auc), 8) AS std_auc FROM aucs GROUP BY model")
def fold_aucs(spark, sf):
    return metrics.fold_aucs(_fold_scores(spark, sf)).select(
        "model", F.round("mean_auc", 8).alias("mean_auc"), F.round("std_auc", 8).alias("std_auc"))


@query("h16_score_histogram", """
vals AS (SELECT Target, s1 AS x FROM scored),
span AS (SELECT *, min(x) OVER (PARTITION BY Target) AS lo,
  (max(x) OVER (PARTITION BY Target) - min(x) OVER (PARTITION BY Target)) / 50 AS w,
  count(*) OVER (PARTITION BY Target) AS total FROM vals)
SELECT Target, cast(least(floor((x - lo) / w), 49) as int) AS bin, count(*) AS n,
  round(count(*) / (total * w), 8) AS density FROM span GROUP BY Target, bin, total, w""")
def score_histogram(spark, sf):
    return metrics.score_histogram(scored_rows(spark, sf, ["s1"]), score="s1").select(
        "Target", "bin", "n", F.round("density", 8).alias("density"))


# --- ensembles ---------------------------------------------------------------

_RANKS = """
mr AS (SELECT *, ar / gn AS pr FROM (SELECT ID, Target, model, rank() OVER (PARTITION BY model ORDER BY score)
  + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0::double AS ar, count(*) OVER (PARTITION BY model) AS gn
  FROM longs))"""


@query("j01_rank_average", f"{_RANKS} SELECT ID, Target, round(sum(ar) / sum(gn), 8) AS score FROM mr GROUP BY ID, Target")
def rank_average(spark, sf):
    return ensemble.rank_average(long_scores(spark, sf)).withColumn("score", F.round("score", 8))


BLEND_TRIALS = 200
RANK_BLEND_TRIALS = 300
BLEND_MODELS = MODELS


def _weights_values(n):
    """Candidate weights as md5 expressions, the rule the search states."""
    unit = ("cast(cast('0x' || substr(md5('42:' || trial || ':w{i}'), 1, 7) as bigint) as double)"
            " / 268435456.0::double")
    cols = ", ".join(f"{unit.format(i=i)} AS w{i}" for i in range(len(BLEND_MODELS)))
    return f"wt AS (SELECT trial, {cols} FROM (SELECT cast(range as int) AS trial FROM range({n})))"


def _blend_sql(source, n):
    whole = " + ".join(f"w{i}" for i in range(len(BLEND_MODELS)))
    mix = " + ".join(f"{m} * (w{i} / ({whole}))" for i, m in enumerate(BLEND_MODELS))
    return (f"{_weights_values(n)}, tr AS (SELECT trial, Target, {mix} AS score FROM {source}, wt),"
            + _auc_sql("tr", ["trial"])
            + " SELECT trial, round(roc_auc, 7) AS roc_auc FROM aucs ORDER BY roc_auc DESC, trial LIMIT 1")


@query("j03_weight_blend", _blend_sql("scored", BLEND_TRIALS))
def weight_blend(spark, sf):
    wide = materialize(scored_rows(spark, sf, BLEND_MODELS))
    _, table = ensemble.weight_search(wide, BLEND_MODELS, BLEND_TRIALS)
    return table.orderBy(F.desc("roc_auc"), "trial").limit(1).withColumn(
        "roc_auc", F.round("roc_auc", 7))


@query("j04_rank_weight_blend", _RANKS + ", rw AS (SELECT ID, Target, "
       + ", ".join(f"max(case when model = '{m}' then pr end) AS {m}" for m in BLEND_MODELS)
       + " FROM mr GROUP BY ID, Target)," + _blend_sql("rw", RANK_BLEND_TRIALS))
def rank_weight_blend(spark, sf):
    ranks = ensemble.model_ranks(long_scores(spark, sf, BLEND_MODELS))
    wide = materialize(ensemble.wide_scores(ranks, BLEND_MODELS, value="pct_rank"))
    _, table = ensemble.weight_search(wide, BLEND_MODELS, RANK_BLEND_TRIALS)
    return table.orderBy(F.desc("roc_auc"), "trial").limit(1).withColumn(
        "roc_auc", F.round("roc_auc", 7))


_FINAL_PART = """(rank() OVER (ORDER BY {e}) + (count(*) OVER (PARTITION BY {e}) - 1) / 2.0::double)"""


@query("j06_mean_of_ranks", "b AS (SELECT ID, Target, floor((0.5 * s1 + 0.5 * s2) * 10000) AS b1, s3 AS b2 FROM scored) SELECT"
       f" ID, Target, round(({_FINAL_PART.format(e='b1')} + {_FINAL_PART.format(e='b2')})"
       " / (2.0::double * count(*) OVER ()), 8) AS score FROM b")
def mean_of_ranks(spark, sf):
    rows = scored_rows(spark, sf, ["s1", "s2", "s3"])
    one = rows.select("ID", "Target", F.expr("cast(floor((0.5D * s1 + 0.5D * s2) * 10000) as double)").alias("score"))
    two = rows.select("ID", "Target", F.col("s3").alias("score"))
    return ensemble.mean_of_ranks([one, two]).withColumn("score", F.round("score", 8))


@query("j07_pair_aucs", f"{_RANKS}, pairs AS (SELECT a.model AS model_a, b.model AS model_b, a.Target,"
       " (a.ar + b.ar) / 2 AS score FROM mr a JOIN mr b ON a.ID = b.ID AND a.model < b.model),"
       + _auc_sql("pairs", ["model_a", "model_b"])
       + " SELECT model_a, model_b, round(roc_auc, 7) AS roc_auc FROM aucs")
def pair_aucs(spark, sf):
    return ensemble.pair_aucs(long_scores(spark, sf), MODELS).withColumn("roc_auc", F.round("roc_auc", 7))


@query("j07_subset_aucs", f"{_RANKS}, subs AS (SELECT 'all' AS subset, ID, Target, sum(ar) AS score FROM mr"
       " GROUP BY ID, Target UNION ALL SELECT 's1_s4', ID, Target, sum(ar) FROM mr WHERE model IN ('s1', 's4')"
       " GROUP BY ID, Target), rs AS (SELECT subset, Target, score FROM subs),"
       + _auc_sql("rs", ["subset"]) + " SELECT subset, round(roc_auc, 6) AS roc_auc FROM aucs")
def subset_aucs(spark, sf):
    got = ensemble.subset_aucs(long_scores(spark, sf), {"all": MODELS, "s1_s4": ["s1", "s4"]})
    return got.withColumn("roc_auc", F.round("roc_auc", 6))


_GREEDY = f"""{_RANKS}, rw AS (SELECT ID, Target, max(case when model = 's1' then ar end) AS s1,
  max(case when model = 's2' then ar end) AS s2, max(case when model = 's3' then ar end) AS s3,
  max(case when model = 's4' then ar end) AS s4 FROM mr GROUP BY ID, Target),
sets AS ({" UNION ALL ".join(
    f"SELECT '{''.join(x)}' AS picks, Target, {' + '.join(('s3',) + x)} AS score FROM rw"
    for x in [(), ('s1',), ('s2',), ('s4',), ('s1', 's2'), ('s1', 's4'), ('s2', 's4'), ('s1', 's2', 's4')])}),""" + (
    _auc_sql("sets", ["picks"]) + """,
a0 AS (SELECT 0 AS step, '' AS picks, 's3' AS model, roc_auc FROM aucs WHERE picks = ''),
a1 AS (SELECT 1 AS step, a.picks, a.picks AS model, a.roc_auc FROM aucs a, a0
  WHERE length(a.picks) = 2 AND a.roc_auc > a0.roc_auc + 1e-7 ORDER BY a.roc_auc DESC, a.picks LIMIT 1),
a2 AS (SELECT 2 AS step, a.picks, replace(a.picks, a1.picks, '') AS model, a.roc_auc FROM aucs a, a1
  WHERE length(a.picks) = 4 AND a.picks LIKE '%' || a1.picks || '%' AND a.roc_auc > a1.roc_auc + 1e-7
  ORDER BY a.roc_auc DESC, a.picks LIMIT 1),
a3 AS (SELECT 3 AS step, a.picks, replace(replace(a.picks, a1.model, ''), a2.model, '') AS model, a.roc_auc
  FROM aucs a, a1, a2 WHERE length(a.picks) = 6 AND a.roc_auc > a2.roc_auc + 1e-7)
SELECT cast(step as int) AS step, model, round(roc_auc, 8) AS roc_auc FROM (SELECT * FROM a0 UNION ALL SELECT * FROM a1
  UNION ALL SELECT * FROM a2 UNION ALL SELECT * FROM a3)""")


@query("j08_greedy_selection", _GREEDY)
def greedy_selection(spark, sf):
    chosen = ensemble.greedy_selection(long_scores(spark, sf), "s3", ["s1", "s2", "s4"])
    return spark.createDataFrame(
        [(i, m, round(a, 8)) for i, (m, a) in enumerate(chosen)],
        "step int, model string, roc_auc double")


# --- submission rules --------------------------------------------------------

def _submission(spark, sf):
    rows = test_rows(spark, sf, ["ID"]).withColumn("k", F.col("ID").cast("bigint"))
    return rows.select("ID", F.when(F.col("k") % 97 != 0, F.expr("cast(k * 31 % 1000 as double) / 1000")).alias("Target")
                       ).where(F.col("ID").cast("bigint") % 89 != 0)


@query("k01_template_order", """
SELECT ID, row_number() OVER (ORDER BY md5(ID)) AS position, cast(cast(ID as bigint) * 31 % 1000 as double) / 1000
  AS Target FROM test""")
def template_positions(spark, sf):
    from loanloom.operators.ordered import hash_row_numbers

    template = test_rows(spark, sf, ["ID"]).withColumn("template_pos", F.md5("ID"))
    scores = template.select("ID", F.expr("cast(cast(ID as bigint) * 31 % 1000 as double) / 1000").alias("Target"))
    rows = submission.align_to_template(scores, template)
    return hash_row_numbers(rows, F.col("template_pos"), "ID", output="position").select(
        "ID", "position", "Target")


@query("k02_rule_violations", """
bad AS (SELECT ID, case when cast(ID as bigint) % 97 <> 0 then 0.5 end AS Target FROM test WHERE cast(ID as bigint) % 89 <> 0),
rules AS (SELECT 'row_count' AS rule, (SELECT count(*) FROM test) - (SELECT count(*) FROM bad) AS n UNION ALL
  SELECT 'missing_id', (SELECT count(*) FROM test WHERE ID NOT IN (SELECT ID FROM bad)) UNION ALL
  SELECT 'null_score', (SELECT count(*) FROM bad WHERE Target IS NULL))
SELECT rule, cast(n as bigint) AS n FROM rules WHERE n > 0""")
def rule_violations(spark, sf):
    return submission.violations(_submission(spark, sf), test_rows(spark, sf, ["ID"]))


@query("k03_shape_check", """
SELECT (SELECT count(*) FROM test) AS template_rows, (SELECT count(*) FROM test WHERE cast(ID as bigint) % 89 <> 0)
  AS rows, true AS same_columns, false AS same_rows""")
def shape_check(spark, sf):
    scores, template = _submission(spark, sf), test_rows(spark, sf, ["ID"])
    same = scores.columns == [ID_COL, TARGET_COL]
    n = template.agg(F.count(F.lit(1)).alias("template_rows")).withColumn("k", F.lit(1))
    m = scores.agg(F.count(F.lit(1)).alias("rows")).withColumn("k", F.lit(1))
    # one row on each side
    return n.join(m, "k").select(
        "template_rows", "rows", F.lit(same).alias("same_columns"),
        (F.col("template_rows") == F.col("rows")).alias("same_rows"))
