"""Queries for encoders, joins and alignment, folds and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.operators import ensemble, folds, joins
from loanloom.operators.encoders import (FoldEncoder, FrequencyEncoder, GroupStatsEncoder,
                                         KFoldTargetEncoder, OneHotEncoder, OrdinalEncoder, WOEEncoder)
from loanloom.operators.features import BaseFeatureEngineer
from loanloom.operators.metrics import roc_auc
from loanloom.operators.variants import build_all_variants
from loanloom.plans.catalog import query
from loanloom.plans.loanview import long_scores, scored_rows, test_rows, train_rows
from loanloom.plans.oracle_prefix import counts
from loanloom.session import materialize

CATS = ["loan_purpose", "employment_sector", "collateral_type", "province"]
BASE = ["ID", "Target", *CATS]


def _split(spark, sf, cols=BASE):
    test_cols = [c for c in cols if c != "Target"]
    return train_rows(spark, sf, cols), test_rows(spark, sf, test_cols)


def _rounded(df, cols, digits=8):
    return df.select("ID", *[F.round(c, digits).alias(c) for c in cols])


def _text(c, alias="t"):
    return f"coalesce(cast({alias}.{c} as varchar), 'nan')"


def _lookup_sql(values, source="test", maps="maps", out=None, digits=8):
    """values: {value column: (output pattern, default or None)} looked up for CATS."""
    picks, joins = [], []
    for i, c in enumerate(out or CATS):
        for v, (name, default) in values.items():
            hit = f"m{i}.{v}"
            if default is not None:
                hit = f"coalesce({hit}, {default})"
            picks.append(f"round({hit}, {digits}) AS {name.format(c)}")
        joins.append(f"LEFT JOIN {maps} m{i} ON m{i}.column_name = '{c}' AND m{i}.category = {_text(c)}")
    return f"SELECT t.ID, {', '.join(picks)} FROM {source} t {' '.join(joins)}"


_COUNTS = f"cc AS ({counts(CATS)}), g AS (SELECT count(*) AS all_n, sum(Target) AS all_pos FROM train)"
_MEAN = "(pos + 10.0::double * all_pos / all_n) / (n + 10.0::double)"
_WOE = ("ln(((n - pos + 0.5::double) / (all_n - all_pos + 1.0::double))"
        " / ((pos + 0.5::double) / (all_pos + 1.0::double)))")
_RATE = "(SELECT all_pos * 1.0::double / all_n FROM g)"


@query("d01_frequency", f"{_COUNTS}, maps AS (SELECT *, n * 1.0::double / all_n AS v FROM cc, g) "
       + _lookup_sql({"v": ("{}", "0.0::double")}))
def frequency(spark, sf):
    train, test = _split(spark, sf)
    return _rounded(FrequencyEncoder(CATS).fit(train, label=None).transform(test), CATS)


@query("d02_ordinal", f"{_COUNTS}, maps AS (SELECT *, cast(row_number() OVER (PARTITION BY column_name"
       " ORDER BY category) - 1 as double) AS v FROM cc) " + _lookup_sql({"v": ("{}", "-1.0::double")}))
def ordinal(spark, sf):
    train, test = _split(spark, sf)
    return _rounded(OrdinalEncoder(CATS).fit(train, label=None).transform(test), CATS)


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "nan"]


@query("d03_one_hot", "SELECT ID, " + ", ".join(
    f"case when coalesce(employment_sector, 'nan') = '{v}' then 1.0::double else 0.0::double end"
    f" AS employment_sector_{v}" for v in _SEGMENTS) + " FROM test")
def one_hot(spark, sf):
    train, test = _split(spark, sf, ["ID", "employment_sector"])
    return OneHotEncoder(["employment_sector"]).fit(train, label=None).transform(test)


@query("d04_target_mean", f"{_COUNTS}, maps AS (SELECT *, {_MEAN} AS v FROM cc, g) "
       + _lookup_sql({"v": ("{}", _RATE)}))
def target_mean(spark, sf):
    train, test = _split(spark, sf)
    return _rounded(KFoldTargetEncoder(CATS).fit(train).transform(test), CATS)


_FOLDED = "trf AS (SELECT t.*, f.fold_id FROM train t JOIN folds f USING (ID))"
_FOLD_COUNTS = f"""{_FOLDED}, fc AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, coalesce(cast({c} as varchar), 'nan') AS category, fold_id,"
    f" count(*) AS n, sum(Target) AS pos FROM trf GROUP BY 2, 3" for c in CATS)}),
fg AS (SELECT fold_id, (SELECT count(*) FROM train) - count(*) AS all_n,
  (SELECT sum(Target) FROM train) - sum(Target) AS all_pos FROM trf GROUP BY fold_id),
g AS (SELECT count(*) AS all_n, sum(Target) AS all_pos FROM train),
pairs AS (SELECT c.column_name, c.category, fg.fold_id, all_n, all_pos,
  sum(case when c.fold_id <> fg.fold_id then n else 0 end) AS n,
  sum(case when c.fold_id <> fg.fold_id then pos else 0 end) AS pos
  FROM fc c, fg GROUP BY 1, 2, 3, 4, 5)"""


def _fold_lookup_sql(values, out=None, source="trf t", fold="t.fold_id", extra=""):
    picks, joins = [], []
    for i, c in enumerate(out or CATS):
        for v, (name, default) in values.items():
            hit = f"m{i}.{v}"
            if default is not None:
                hit = f"coalesce({hit}, {default})"
            picks.append(f"round({hit}, 8) AS {name.format(c)}")
        joins.append(f"LEFT JOIN maps m{i} ON m{i}.column_name = '{c}' AND m{i}.category = {_text(c)}"
                     f" AND m{i}.fold_id = {fold}")
    return f"SELECT t.ID, {extra}{', '.join(picks)} FROM {source} {' '.join(joins)}"


def _folded(spark, sf, cols=BASE):
    train = materialize(train_rows(spark, sf, cols))
    return train.join(folds.make_folds(train), "ID")


@query("d05_oof_target", f"{_FOLD_COUNTS}, maps AS (SELECT *, {_MEAN} AS v FROM pairs WHERE n > 0) "
       + _fold_lookup_sql({"v": ("{}", _RATE)}))
def oof_target(spark, sf):
    rows = materialize(_folded(spark, sf))
    return _rounded(KFoldTargetEncoder(CATS).fit(rows, fold="fold_id").transform_train(rows), CATS)


@query("d06_woe", f"{_COUNTS}, maps AS (SELECT *, {_WOE} AS v FROM cc, g) "
       + _lookup_sql({"v": ("{}", "0.0::double")}))
def woe(spark, sf):
    train, test = _split(spark, sf)
    return _rounded(WOEEncoder(CATS).fit(train).transform(test), CATS)


@query("d07_group_stats", f"{_COUNTS}, maps AS (SELECT *, pos * 1.0::double / n AS r FROM cc) " + """
SELECT t.ID, round(a.r, 8) AS province_default_rate, a.n AS province_loan_count,
  round(b.r, 8) AS employment_sector_default_rate, b.n AS employment_sector_loan_count
FROM test t LEFT JOIN maps a ON a.column_name = 'province' AND a.category = coalesce(t.province, 'nan')
LEFT JOIN maps b ON b.column_name = 'employment_sector' AND b.category = coalesce(t.employment_sector, 'nan')""")
def group_stats(spark, sf):
    train, test = _split(spark, sf, ["ID", "Target", "province", "employment_sector"])
    out = GroupStatsEncoder().fit(train).transform(test)
    return out.select(
        "ID", *[c for g in ("province", "employment_sector")
                for c in (F.round(f"{g}_default_rate", 8).alias(f"{g}_default_rate"), f"{g}_loan_count")])


@query("d08_within_fold", f"{_FOLD_COUNTS}, maps AS (SELECT *, {_MEAN} AS v, {_WOE} AS w FROM pairs WHERE n > 0),"
       " spread AS (SELECT trf.*, fg.fold_id AS held_out_fold, all_pos * 1.0::double / all_n AS prior,"
       " case when trf.fold_id = fg.fold_id then 'valid' else 'train' end AS part FROM trf, fg) "
       + _fold_lookup_sql({"v": ("{}", "t.prior"), "w": ("{}_woe", "0.0::double")}, source="spread t",
                          fold="t.held_out_fold", extra="held_out_fold, part, ",
                          out=["province", "employment_sector"]))
def within_fold(spark, sf):
    cats = ["province", "employment_sector"]
    rows = materialize(_folded(spark, sf, ["ID", "Target", *cats]))
    enc = FoldEncoder(cats, group_cols=["none"]).fit(rows)
    out = None
    for k in enc.stats.folds:
        part = F.when(F.col("fold_id") == k, "valid").otherwise("train").alias("part")
        one = enc.transform_for_fold(rows, k).select(
            "ID", F.lit(k).alias("held_out_fold"), part,
            *[F.round(c, 8).alias(c) for g in cats for c in (g, f"{g}_woe")])
        out = one if out is None else out.unionByName(one)
    return out


# categories of the engineered features, those with few values, and the rank features
FE_CATS = ["product_code", "payment_frequency", "loan_purpose", "client_gender", "marital_status", "employment_sector", "collateral_type",
           "disbursement_channel", "province", "province_sector", "product_purpose", "channel_province"]
FE_LOW = [c for c in FE_CATS if c not in ("province_sector", "product_purpose")]
FE_RANKS = [("amount_rank_in_product", "amount_usd", "product_code"), ("income_rank_in_province", "monthly_income_usd", "province")]


def _variant(spark, sf, name, **options):
    return _variants(spark, sf, [name], **options)[name]


def _variants(spark, sf, names, **options):
    """Variants of all raw columns, rank features included."""
    train = materialize(train_rows(spark, sf))
    test = materialize(test_rows(spark, sf).drop("Target"))
    return build_all_variants(train, test, folds.make_folds(train), names, engineer=BaseFeatureEngineer(), **options)


def _halves(pair, cols):
    """Asked columns of both halves: (ID, part, columns, ranks)."""
    ranks = [F.round(n, 8).alias(n) for n, _, _ in FE_RANKS]
    one, two = (df.select("ID", F.lit(part).alias("part"), *cols, *ranks) for df, part in zip(pair, ("train", "test"), strict=True))
    return one.unionByName(two)


_IMPUTED = ("fcc AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS category, count(*) AS n, sum(Target) AS pos FROM fe"
    f" WHERE is_test = 0 GROUP BY 2" for c in FE_CATS) + ")")
# ranks are taken among the rows of a half
_RANKED = "fr AS (SELECT *, case when is_test = 0 then 'train' else 'test' end AS part, " + ", ".join(
    f"round((rank() OVER (PARTITION BY is_test, {g} ORDER BY {v}) + (count(*) OVER (PARTITION BY is_test, {g}, {v}) - 1) / 2.0::double)"
    f" / count(*) OVER (PARTITION BY is_test, {g}), 8) AS {n}" for n, v, g in FE_RANKS) + " FROM fe)"
_RANK_NAMES = ", ".join(n for n, _, _ in FE_RANKS)


def _hot_columns(df, kept):
    """Names of the hot columns of a row, sorted and joined."""
    hot = [c for c in df.columns if c not in kept]
    names = F.array(*[F.when(F.col(f"`{c}`") == 1, F.lit(c)) for c in hot])
    return F.array_join(F.array_sort(F.filter(names, lambda n: n.isNotNull())), "|").alias("hot")


_HOT = ("array_to_string(list_sort(list_filter([" + ", ".join(
    f"case when {c} IN (SELECT category FROM fcc WHERE column_name = '{c}') then '{c}_' || {c} end" for c in FE_CATS)
    + "], lambda x: x IS NOT NULL)), '|')")


@query("d09_one_hot_variant", f"{_IMPUTED}, {_RANKED} SELECT ID, part, {_HOT} AS hot, {_RANK_NAMES} FROM fr")
def one_hot_variant(spark, sf):
    made = _variants(spark, sf, ["v1_ohe", "v2_ordinal"])
    return _halves(made["v1_ohe"], [_hot_columns(made["v1_ohe"][1], set(made["v2_ordinal"][0].columns))])


_CODES = "maps AS (SELECT *, cast(row_number() OVER (PARTITION BY column_name ORDER BY category) - 1 as double) AS v FROM fcc)"


def _codes_sql():
    picks = ", ".join(f"coalesce(m{i}.v, -1.0::double) AS {c}" for i, c in enumerate(FE_CATS))
    found = " ".join(f"LEFT JOIN maps m{i} ON m{i}.column_name = '{c}' AND m{i}.category = t.{c}" for i, c in enumerate(FE_CATS))
    return f"SELECT t.ID, t.part, {picks}, {', '.join(f't.{n}' for n, _, _ in FE_RANKS)} FROM fr t {found}"


@query("d10_ordinal_variant", f"{_IMPUTED}, {_RANKED}, {_CODES} {_codes_sql()}")
def ordinal_variant(spark, sf):
    return _halves(_variant(spark, sf, "v2_ordinal"), FE_CATS)


_FOLD_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS category, fold_id, count(*) AS n, sum(fe.Target) AS pos FROM fe JOIN folds USING (ID) GROUP BY 2, 3"
    for c in FE_CATS)
# statistics of all training rows (fold -1) and outside each fold
_OUTSIDE = (f"ffc AS ({_FOLD_COUNTS}),"
            " tot AS (SELECT fold_id, count(*) AS n, sum(Target) AS pos FROM train JOIN folds USING (ID) GROUP BY 1),"
            " rest AS (SELECT k.fold_id, sum(o.n) AS all_n, sum(o.pos) AS all_pos FROM tot k JOIN tot o ON o.fold_id <> k.fold_id GROUP BY 1"
            " UNION ALL SELECT -1, sum(n), sum(pos) FROM tot),"
            " oc AS (SELECT k.fold_id, column_name, category, sum(f.n) AS n, sum(f.pos) AS pos FROM tot k JOIN ffc f ON f.fold_id <> k.fold_id"
            " GROUP BY 1, 2, 3 UNION ALL SELECT -1, column_name, category, sum(n), sum(pos) FROM ffc GROUP BY 2, 3),"
            f" maps AS (SELECT *, {_MEAN} AS v, {_WOE} AS w, pos::double / n AS r FROM oc JOIN rest USING (fold_id)),"
            " fk AS (SELECT fr.*, coalesce(folds.fold_id, -1) AS k FROM fr LEFT JOIN folds USING (ID))")


def _target_sql():
    picks, found = [], []
    for i, c in enumerate(FE_CATS):
        picks.append(f"round(coalesce(m{i}.v, p.all_pos::double / p.all_n), 8) AS {c}")
        if c in FE_LOW:
            picks.append(f"round(coalesce(m{i}.w, 0.0::double), 8) AS {c}_woe")
        if c in ("province", "employment_sector"):
            picks.append(f"round(m{i}.r, 8) AS {c}_default_rate, cast(m{i}.n as bigint) AS {c}_loan_count")
        found.append(f"LEFT JOIN maps m{i} ON m{i}.column_name = '{c}' AND m{i}.category = t.{c} AND m{i}.fold_id = t.k")
    ranks = ", ".join(f"t.{n}" for n, _, _ in FE_RANKS)
    return f"SELECT t.ID, t.part, {', '.join(picks)}, {ranks} FROM fk t JOIN rest p ON p.fold_id = t.k {' '.join(found)}"


@query("d11_target_woe_variant", f"{_RANKED}, {_OUTSIDE} {_target_sql()}")
def target_woe_variant(spark, sf):
    """Training rows see the other folds only, test rows all training rows."""
    rounded = [*FE_CATS, *[f"{c}_woe" for c in FE_LOW], *[f"{c}_default_rate" for c in ("province", "employment_sector")]]
    counted = [F.col(f"{c}_loan_count").cast("long").alias(f"{c}_loan_count") for c in ("province", "employment_sector")]
    return _halves(_variant(spark, sf, "v3_target_woe"), [*[F.round(c, 8).alias(c) for c in rounded], *counted])


_LEAKY = f"""{_IMPUTED}, g AS (SELECT count(*) AS all_n, sum(Target) AS all_pos FROM train),
w AS (SELECT *, {_WOE} AS w FROM fcc, g),
ftr AS (SELECT fe.*, fold_id FROM fe JOIN folds USING (ID) WHERE is_test = 0)
SELECT t.ID, round(w.w, 8) AS province_woe, round(w.pos * 1.0::double / w.n, 8) AS province_default_rate,
  w.n AS province_loan_count
FROM ftr t LEFT JOIN w ON w.column_name = 'province' AND w.category = t.province"""


@query("d11_full_fit_variant", _LEAKY)
def full_fit_variant(spark, sf):
    train = _variant(spark, sf, "v3_target_woe", leak_safe=False)[0]
    return train.select("ID", F.round("province_woe", 8).alias("province_woe"),
                        F.round("province_default_rate", 8).alias("province_default_rate"),
                        "province_loan_count")


@query("d12_all_variants", f"{_IMPUTED}, {_RANKED}, codes AS (SELECT column_name, category,"
       f" cast(row_number() OVER (PARTITION BY column_name ORDER BY category) - 1 as double) AS v FROM fcc), {_OUTSIDE},"
       f" a AS (SELECT ID, 'v1_ohe' AS variant, part, {_HOT} AS encoded, {_RANK_NAMES} FROM fr),"
       f" b AS (SELECT ID, 'v2_ordinal' AS variant, part, cast(cast(coalesce(v, -1) as int) as varchar) AS encoded, {_RANK_NAMES}"
       " FROM fr LEFT JOIN codes ON column_name = 'province_sector' AND category = province_sector),"
       f" c AS (SELECT ID, 'v3_target_woe' AS variant, part, cast(cast(round(coalesce(v, p.all_pos::double / p.all_n) * 1000000) as int)"
       f" as varchar) AS encoded, {_RANK_NAMES} FROM fk JOIN rest p ON p.fold_id = k LEFT JOIN maps ON maps.column_name = 'province_sector'"
       " AND maps.category = province_sector AND maps.fold_id = k)"
       " SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c")
def all_variants(spark, sf):
    """All rows of both halves of the three variants, with what each makes of the categories."""
    made = _variants(spark, sf, ["v1_ohe", "v2_ordinal", "v3_target_woe"])
    encoded = {
        "v1_ohe": _hot_columns(made["v1_ohe"][1], set(made["v2_ordinal"][0].columns)).alias("encoded"),
        "v2_ordinal": F.col("province_sector").cast("int").cast("string").alias("encoded"),
        "v3_target_woe": F.round(F.col("province_sector") * 1000000).cast("int").cast("string").alias("encoded")}
    out = None
    for name, pair in made.items():
        one = _halves(pair, [F.lit(name).alias("variant"), encoded[name]])
        out = one if out is None else out.unionByName(one)
    return out


# --- joins, alignment, sets --------------------------------------------------

@query("e01_lookup_default", """
freq AS (SELECT collateral_type AS v, count(*) * 1.0::double / (SELECT count(*) FROM train) AS f
  FROM train WHERE collateral_type IS NOT NULL GROUP BY 1)
SELECT t.ID, round(coalesce(f, 0.0::double), 8) AS collateral_share
FROM test t LEFT JOIN freq ON v = collateral_type""")
def lookup_default(spark, sf):
    train, test = _split(spark, sf, ["ID", "collateral_type"])
    seen = train.where("collateral_type is not null").groupBy("collateral_type").agg(
        F.count(F.lit(1)).alias("n"))
    table = materialize(seen.withColumn("f", F.col("n") / F.lit(train.count())))
    found = joins.lookup(test, table, ["collateral_type"], table.count(), "n")
    return found.select("ID", F.round(F.coalesce("f", F.lit(0.0)), 8).alias("collateral_share"))


@query("e02_merge_stats", """
SELECT t.ID, s.mean_amount FROM test t LEFT JOIN
  (SELECT province, round(avg(amount_usd), 4) AS mean_amount FROM train GROUP BY province) s USING (province)""")
def merge_stats(spark, sf):
    train = train_rows(spark, sf, ["province", "amount_usd"])
    test = test_rows(spark, sf, ["ID", "province"])
    stats = materialize(train.groupBy("province").agg(
        F.round(F.avg("amount_usd"), 4).alias("mean_amount"), F.count(F.lit(1)).alias("n")))
    return joins.lookup(test, stats, ["province"], stats.count(), "n").select("ID", "mean_amount")


def _template(spark, sf):
    t = test_rows(spark, sf, ["ID"])
    return t.select("ID", (F.md5("ID")).alias("template_pos"))


@query("e03_template_order", """
SELECT ID, cast(cast(ID as bigint) * 31 % 1000 as double) / 1000 AS Target, true AS found,
  md5(ID) AS template_pos FROM test""")
def template_order(spark, sf):
    from loanloom.sources.submission import align_to_template

    scores = test_rows(spark, sf, ["ID"]).withColumn("Target", F.expr("cast(cast(ID as bigint) * 31 % 1000 as double) / 1000"))
    return align_to_template(scores, _template(spark, sf))


@query("e04_prediction_matrix", "SELECT ID, Target, s1, s2, s3, s4 FROM scored")
def prediction_matrix(spark, sf):
    return ensemble.wide_scores(long_scores(spark, sf), ["s1", "s2", "s3", "s4"])


@query("e05_fold_split", f"{_FOLDED} SELECT case when fold_id = 2 then 'valid' else 'train' end AS part,"
       " count(*) AS n, cast(sum(Target) as bigint) AS pos FROM trf GROUP BY 1")
def fold_split(spark, sf):
    train = train_rows(spark, sf, ["ID", "Target"])
    tr, va = folds.fold_parts(train, folds.make_folds(train), 2)
    both = tr.withColumn("part", F.lit("train")).unionByName(va.withColumn("part", F.lit("valid")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("Target").alias("pos"))


@query("e06_train_test_union", """
SELECT ID, coalesce(amount_usd, 0.0::double) AS amount_usd, coalesce(monthly_income_usd, 0.0::double)
  AS monthly_income_usd, is_test AS _is_test FROM loans""")
def train_test_union(spark, sf):
    from loanloom.operators.training import origin_frame

    cols = ["ID", "amount_usd", "monthly_income_usd", "province"]
    return origin_frame(train_rows(spark, sf, [*cols, "Target"]), test_rows(spark, sf, cols))


@query("e07_disjoint_keys", """
SELECT (SELECT count(*) FROM train JOIN test USING (ID)) AS shared,
  (SELECT count(*) FROM (SELECT ID FROM train UNION SELECT ID FROM test)) AS both""")
def disjoint_keys(spark, sf):
    a, b = train_rows(spark, sf, ["ID"]), test_rows(spark, sf, ["ID"])
    sides = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), "ID", "full")
    return sides.agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("shared"),
                     F.count(F.lit(1)).alias("both"))


@query("e08_model_pairs", """
SELECT a.model AS model_a, b.model AS model_b, count(*) AS n, round(avg(abs(a.score - b.score)), 8) AS mean_gap
FROM longs a JOIN longs b ON a.ID = b.ID AND a.model < b.model GROUP BY 1, 2""")
def model_pairs(spark, sf):
    from itertools import combinations

    models = ["s1", "s2", "s3", "s4"]
    wide = scored_rows(spark, sf, models)
    # a handful of models: their pairs are listed in the plan, rows are not joined
    items = F.array(*[F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"),
                               F.abs(F.col(a) - F.col(b)).alias("gap")) for a, b in combinations(models, 2)])
    return wide.select(F.explode(items).alias("p")).select("p.*").groupBy("model_a", "model_b").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("gap"), 8).alias("mean_gap"))


# --- folds and splits --------------------------------------------------------

@query("f01_stratified_folds", "SELECT ID, fold_id FROM folds")
def stratified_folds(spark, sf):
    return folds.make_folds(train_rows(spark, sf, ["ID", "Target"]))


@query("f02_fold_validation", f"""{_FOLDED}
SELECT fold_id, count(*) AS n, cast(sum(Target) as bigint) AS pos, round(avg(Target), 9) AS fold_rate,
  round((SELECT avg(Target) FROM train), 9) AS overall_rate,
  abs(avg(Target) - (SELECT avg(Target) FROM train)) > 0.02 AS off FROM trf GROUP BY fold_id""")
def fold_validation(spark, sf):
    train = train_rows(spark, sf, ["ID", "Target"])
    return folds.fold_summary(train, folds.make_folds(train)).withColumns(
        {"fold_rate": F.round("fold_rate", 9), "overall_rate": F.round("overall_rate", 9)})


@query("f03_holdout", """
n AS (SELECT ID, Target, row_number() OVER (PARTITION BY Target ORDER BY md5(ID || ':42'), ID) AS rn,
  count(*) OVER (PARTITION BY Target) AS c FROM train)
SELECT ID, cast(case when rn <= floor((6 * c + 10) / 20) then 1 else 0 end as int) AS is_holdout FROM n""")
def holdout(spark, sf):
    return folds.holdout_split(train_rows(spark, sf, ["ID", "Target"]))


@query("f04_hash_sample", "SELECT ID, amount_usd FROM train ORDER BY md5(ID || ':42'), ID LIMIT 100")
def hash_sample(spark, sf):
    return folds.hash_sample(train_rows(spark, sf, ["ID", "amount_usd"]), 100)


# --- flagship ----------------------------------------------------------------

_FLAG_CATS = ["loan_purpose", "employment_sector", "collateral_type", "province"]


@query("flagship_oof_auc", f"{_FOLD_COUNTS}, maps AS (SELECT *, {_MEAN} AS v FROM pairs WHERE n > 0), enc AS (SELECT"
       " Target, t.* FROM (" + _fold_lookup_sql({"v": ("{}", _RATE)}) + ") t JOIN train USING (ID)), tall AS ("
       + " UNION ALL ".join(f"SELECT '{c}' AS feature, Target, {c} AS x FROM enc" for c in CATS) + """),
ranked AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY x)
  + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0::double AS r FROM tall)
SELECT feature, round((sum(case when Target = 1 then r else 0 end) - sum(Target) * (sum(Target) + 1) / 2)
  / (sum(Target) * sum(1 - Target)), 8) AS roc_auc FROM ranked GROUP BY feature""")
def flagship(spark, sf):
    """View -> folds -> out-of-fold target means -> exact AUC of every encoded category."""
    rows = materialize(_folded(spark, sf))
    enc = KFoldTargetEncoder(_FLAG_CATS).fit(rows, fold="fold_id").transform_train(rows)
    tall = enc.select("Target", *[F.round(c, 8).alias(c) for c in _FLAG_CATS]).unpivot(
        ["Target"], _FLAG_CATS, "feature", "score")
    return roc_auc(tall, keys=["feature"]).select("feature", F.round("roc_auc", 8).alias("roc_auc"))


