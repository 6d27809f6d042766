"""Training queries. Tree learners have no SQL twin; the registry is checked with a scorecard that SQL can fit."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import evaluation, models, scoring
from riskframe.operators.orderstats import auc
from riskframe.operators.profile import attribution_summary
from riskframe.operators.sampling import SmoteResampler, assign_folds, hash_sample, stratified_flag, stratified_split
from riskframe.operators.woe import WoETransformer
from riskframe.plans.encoding import FEATURES, sql_evidence, sql_in_bin
from riskframe.plans.registry import query, r6
from riskframe.plans.scores import records
from riskframe.plans.views import CREDIT_SQL, EARLY_SQL, LINE_KEY, credit, early, late, sql_uniform
from riskframe.session import cut_lineage, scratch_path, written
from riskframe.sources.runs import RunRegistry

# The rounds of the gate, at the depth of the early-stopping run.
ROUNDS = {**models.GATE_PARAMS, "maxDepth": 4}
#: A higher WoE of these must not raise the risk.
DIRECTIONS = {"l_quantity": -1, "l_discount": -1}


def _encoded(spark, sf_dir):
    """Encoded training and test rows of the credit view, and the features."""
    # The target is a hash of the key, which costs more than reading a row: it is worked out once.
    data = written(credit(spark, sf_dir).select(*LINE_KEY, *FEATURES, "y"), "credit")
    data = written(stratified_flag(data, "y", LINE_KEY), "flagged")
    train, test = data.where("not is_test"), data.where("is_test")
    encoder = WoETransformer("y", exclude_cols=(*LINE_KEY, "is_test")).fit(train)
    return (
        written(encoder.transform(train, keep_target=True, keep_cols=LINE_KEY), "train"),
        written(encoder.transform(test, keep_target=True, keep_cols=LINE_KEY), "test"),
        encoder.get_selected_features(),
    )


@query("tstr_gbt")
def tstr_gbt(spark, sf_dir):
    """The earlier lines play the real table, the later ones the synthetic one."""
    data = credit(spark, sf_dir)
    real = early(data).select(*LINE_KEY, *FEATURES, "y")
    synthetic = late(data).select(*FEATURES, "y")
    return evaluation.evaluate_tstr(real, synthetic, "y", LINE_KEY, params=ROUNDS, directions=DIRECTIONS)


@query(
    "gate_directions",
    f"""WITH {CREDIT_SQL}, n AS (SELECT ceil(0.3::DOUBLE * count(*))::BIGINT AS n FROM credit WHERE {EARLY_SQL})
SELECT model, feature, 4 * n AS n_steps, 0::BIGINT AS n_violations FROM n, (SELECT unnest(['TRTR', 'TSTR']) AS model), (SELECT unnest(['l_discount', 'l_quantity']) AS feature)""",
)
def gate_directions(spark, sf_dir):
    """The directed scorecards of the gate's two sides, audited on the same real test rows."""
    data = credit(spark, sf_dir)
    real, synthetic = written(early(data).select(*LINE_KEY, *FEATURES, "y"), "real"), written(late(data).select(*FEATURES, "y"), "synthetic")
    train, test = stratified_split(real, "y", LINE_KEY)
    rows = None
    for name, frame in (("TRTR", train), ("TSTR", synthetic)):
        encoder = WoETransformer("y", iv_threshold=0.0, exclude_cols=tuple(LINE_KEY)).fit(frame)
        judged = encoder.transform(test, keep_target=True, keep_cols=LINE_KEY)
        fitted = written(encoder.transform(frame, keep_target=True), "fitted")
        _, audit = evaluation.directed_scorecard(fitted, judged, encoder.get_selected_features(), "y", LINE_KEY, DIRECTIONS)
        audit = audit.select(F.lit(name).alias("model"), "*")
        rows = audit if rows is None else rows.unionByName(audit)
    return rows


@query("tuned_gbt")
def tuned_gbt(spark, sf_dir):
    """The ten draws of the library's grid over three folds, by successive halving of the draws; every trial's AUC."""
    train, _, features = _encoded(spark, sf_dir)
    folded = assign_folds(train, "y", LINE_KEY)
    _, best, trials = models.tune_gbt_by_rounds(folded, features, "y", "fold", refit=False)
    rows = [(str(p), r, float(a), p == best) for p, r, a in trials]
    return spark.createDataFrame(rows, "params string, rounds int, cv_auc double, best boolean")


@query("ablation")
def ablation(spark, sf_dir):
    """AUC on raw ordinal codes against AUC on WoE values."""
    scored = evaluation.ablation(credit(spark, sf_dir).select(*LINE_KEY, *FEATURES, "y"), "y", LINE_KEY, ROUNDS, 0.02)
    return auc(written(scored.select("y", "p_raw", "p_woe"), "scored"), "y", ["p_raw", "p_woe"])


@query("monotone_scorecard")
def monotone_scorecard(spark, sf_dir):
    """A scorecard whose WoE weights may not be positive, and the audit of its direction."""
    train, test, features = _encoded(spark, sf_dir)
    card = models.train_scorecard(train, features, "y", {f: -1 for f in features})
    scored = card.score(test)
    audit = evaluation.sweep_audit(card, test, LINE_KEY, {features[0]: -1}, [-1.0, -0.5, 0.0, 0.5, 1.0]).first()
    weights = spark.createDataFrame(
        [(f, w, audit["n_steps"], audit["n_violations"]) for f, w in zip(card.features, card.coefficients)],
        "feature string, weight double, n_steps long, n_violations long",
    )
    found = auc(scored, "y", "probability").first()["auc"]
    return weights.withColumn("test_auc", F.lit(found))


@query(
    "monotone_audit",
    f"WITH {CREDIT_SQL} SELECT 4 * ceil(0.3::DOUBLE * count(*))::BIGINT AS n_steps, 0::BIGINT AS n_violations FROM credit",
)
def monotone_audit(spark, sf_dir):
    """Steps of a sweep over five values of the strongest feature, for every test row, and those in the wrong direction."""
    train, test, features = _encoded(spark, sf_dir)
    card = models.train_scorecard(train, features, "y", {f: -1 for f in features})
    return evaluation.sweep_audit(card, test, LINE_KEY, {features[0]: -1}, [-1.0, -0.5, 0.0, 0.5, 1.0]).drop("feature")


@query(
    "training_folds",
    f"""WITH {CREDIT_SQL}, sizes AS (SELECT y, count(*) AS n_c, sum(count(*)) OVER () AS n FROM credit GROUP BY y),
exact AS (SELECT y, (n - ceil(0.3::DOUBLE * n)) AS n_train, n_train * n_c / n::DOUBLE AS share, floor(share)::BIGINT AS base FROM sizes),
train AS (SELECT y, base + CASE WHEN row_number() OVER (ORDER BY share - base DESC, y::VARCHAR) <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS n
  FROM exact)
SELECT y, fold, (n // 3 + CASE WHEN fold < n % 3 THEN 1 ELSE 0 END)::BIGINT AS n_original, (max(n) OVER ())::BIGINT AS n_class
FROM train, (SELECT unnest([0, 1, 2])::INT AS fold)""",
)
def training_folds(spark, sf_dir):
    """What the training run tunes on: original rows per class and fold, and rows per class after oversampling."""
    train, _, _ = _encoded(spark, sf_dir)
    balanced = written(SmoteResampler("y", key=LINE_KEY, tag="origin").fit_resample_combined(train), "balanced")
    folded = evaluation.training_folds(balanced, train, "y", LINE_KEY)
    counted = folded.groupBy("y", "fold").agg(F.count_if(F.col("origin") == "original").alias("n_original"), F.count("*").alias("n"))
    classes = counted.groupBy("y").agg(F.sum("n").alias("n_class"))
    return counted.join(classes, "y").select("y", "fold", "n_original", "n_class")


@query("learning_curve")
def learning_curve(spark, sf_dir):
    train, test, features = _encoded(spark, sf_dir)
    model = models.train_gbt(train, features, "y", ROUNDS)
    return models.learning_curve(model, {"train": train, "test": test}, "y")


@query("early_stopping")
def early_stopping(spark, sf_dir):
    """The curve of the run that stops early: rounds up to ten behind the best one, which the model keeps."""
    train, test, features = _encoded(spark, sf_dir)
    model, curve = models.train_early_stopped(train.unionByName(test), features, "y", LINE_KEY)
    return curve.withColumn("kept_trees", F.lit(len(model.stages[1].treeWeights)))


@query("tree_attribution")
def tree_attribution(spark, sf_dir):
    """Mean absolute log-odds contribution per feature over every test row, and the largest additivity error."""
    train, test, features = _encoded(spark, sf_dir)
    model = models.train_gbt(train, features, "y", ROUNDS)
    explained = cut_lineage(models.tree_attributions(model, models.predict(model, test)))
    total = F.aggregate("attributions", F.col("base_value"), lambda s, a: s + a["value"])
    gap = explained.agg(F.max(F.abs(total - F.ln(F.col("probability") / (F.lit(1.0) - F.col("probability"))))).alias("gap")).first()
    summary = attribution_summary(explained, "attributions")
    return summary.withColumns({"additivity_error": F.lit(gap["gap"]), "mean_abs": r6("mean_abs")})


@query("attribution_sample")
def attribution_sample(spark, sf_dir):
    """The fixed-size sample a summary plot shows: 250 explained rows."""
    train, test, features = _encoded(spark, sf_dir)
    model = models.train_gbt(train, features, "y", ROUNDS)
    return models.tree_attributions(model, hash_sample(test, 250, LINE_KEY)).select(*LINE_KEY, "attributions", "base_value")


@query("credit_training")
def credit_training(spark, sf_dir):
    """Split, encode, oversample, tune, judge, gate and register in one run; beside the decision what the registry then holds."""
    data = written(credit(spark, sf_dir).select(*LINE_KEY, *FEATURES, "y"), "credit")
    registry = RunRegistry(spark, scratch_path(spark, "registry"))
    row, _, _, best = evaluation.train_credit_model(data, "y", LINE_KEY, "run-1", "credit_model", registry=registry)
    logged = {r["key"]: F.lit(r["num_value"]) for r in registry.metrics().where("kind = 'metric'").collect()}  # two
    return row.withColumns({"best": F.lit(str(best)), "n_snapshot": F.lit(registry.read("run-1", "snapshot").count()), **logged})


def _run_sql(run_id: str, where: str) -> str:
    """A training run over some of the credit lines: metrics of the naive scorecard on its test rows, and what it keeps."""
    split = f"""{CREDIT_SQL}, part AS (SELECT * FROM credit WHERE {where}),
ranked AS (SELECT *, count(*) OVER (PARTITION BY y) AS n_c, count(*) OVER () AS n, row_number() OVER (PARTITION BY y ORDER BY {sql_uniform('42', *LINE_KEY)},
    concat_ws('|', {', '.join(LINE_KEY)})) AS r FROM part),
classes AS (SELECT DISTINCT y, n_c, n, n - ceil(0.3::DOUBLE * n)::BIGINT AS n_train FROM ranked),
exact AS (SELECT *, n_train * n_c / n::DOUBLE AS share, floor(n_train * n_c / n::DOUBLE)::BIGINT AS base FROM classes),
given AS (SELECT y, base + CASE WHEN row_number() OVER (ORDER BY share - base DESC, y::VARCHAR) <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS train FROM exact),
flagged AS (SELECT ranked.*, r <= n_c - train AS is_test FROM ranked JOIN given USING (y)),
train AS (SELECT * FROM flagged WHERE NOT is_test), test AS (SELECT * FROM flagged WHERE is_test)"""
    return f"""({sql_evidence(split, 'train', ['l_quantity'], ['l_returnflag', 'l_discount'])},
prior AS (SELECT ln(sum(y) / sum(1 - y)::DOUBLE) AS a FROM train),
judged AS (SELECT t.y, a - coalesce(q.woe, 0) - coalesce(f.woe, 0) - coalesce(d.woe, 0) AS s FROM test t JOIN prior ON TRUE
  LEFT JOIN (SELECT * FROM evidence WHERE feature = 'l_returnflag') f ON f.category = t.l_returnflag
  LEFT JOIN (SELECT * FROM evidence WHERE feature = 'l_discount') d ON d.category = t.l_discount::VARCHAR
  LEFT JOIN (SELECT * FROM evidence WHERE feature = 'l_quantity') q ON {sql_in_bin('t.l_quantity', 'q')}),
auc AS (SELECT sum(pos * (upto - neg / 2)) / (sum(pos)::DOUBLE * sum(neg)) AS auc FROM (
  SELECT sum(y) AS pos, sum(1 - y) AS neg, sum(sum(1 - y)) OVER (ORDER BY round(s, 9)) AS upto FROM judged GROUP BY round(s, 9))),
f1 AS (SELECT count(*) FILTER (WHERE y = 1 AND s > 0) AS tp, count(*) FILTER (WHERE y = 0 AND s > 0) AS fp, count(*) FILTER (WHERE y = 1 AND s <= 0) AS fn FROM judged)
SELECT '{run_id}' AS run_id, (SELECT count(*) FROM test) AS n_snapshot, (SELECT count(*) FROM evidence) AS n_woe, round(auc, 6) AS auc,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM auc, f1)"""


@query(
    "run_registry",
    f"""WITH runs AS ({_run_sql('run-early', EARLY_SQL)} UNION ALL {_run_sql('run-all', 'TRUE')})
SELECT *, CASE run_id WHEN 'run-early' THEN '1' ELSE '2' END AS version, CASE run_id WHEN 'run-early' THEN 'Archived' ELSE 'Production' END AS stage FROM runs""",
)
def run_registry(spark, sf_dir):
    """Two committed training runs, a retry of the first, and one that dies before its commit, as readers find them."""
    registry = RunRegistry(spark, scratch_path(spark, "registry"))
    data = credit(spark, sf_dir).select(*LINE_KEY, "l_quantity", "l_returnflag", "l_discount", "l_shipdate", "y")
    data = cut_lineage(data)
    for run_id, rows in (("run-early", early(data)), ("run-all", data), ("run-early", late(data))):
        evaluation.train_scorecard_run(rows.drop("l_shipdate"), "y", LINE_KEY, registry, run_id, "credit_model", iv_threshold=0.0, threshold=0.5)
    lost = registry.begin("run-lost")
    lost.write("snapshot", data.limit(10))
    lost.log({"AUC": 1.0})
    found = registry.metrics().where("kind = 'metric'").groupBy("run_id").pivot("key", ["AUC", "F1_Score"]).agg(F.first("num_value"))
    sizes = []
    for r in registry.commits().collect():  # one per run
        kept = scoring.Scorer.load(spark, registry.artefact(r["run_id"], "scorer"))
        sizes.append((r["run_id"], registry.read(r["run_id"], "snapshot").count(), kept.encoder.woe_table.count()))
    sizes = spark.createDataFrame(sizes, "run_id string, n_snapshot long, n_woe long")
    joined = registry.versions().join(found, "run_id").join(sizes, "run_id")
    return joined.select("run_id", "version", "stage", r6("AUC").alias("auc"), r6("F1_Score").alias("f1"), "n_snapshot", "n_woe")


@query("tree_scores")
def tree_scores(spark, sf_dir):
    """Every line scored by boosted trees over WoE values, with grades and the leading feature."""
    train, _, features = _encoded(spark, sf_dir)
    encoder = WoETransformer("y", cache_input=True).fit(credit(spark, sf_dir).select(*FEATURES, "y"))
    scorer = scoring.Scorer(encoder, models.train_gbt(train, features, "y", ROUNDS))
    scored = scorer.score(records(spark, sf_dir))
    leading = F.get(F.col("shap_values"), 0)["feature"]
    return scored.groupBy("grade", leading.alias("leading_feature")).agg(
        F.count("*").alias("n"), F.avg("probability").alias("mean_probability")
    )
