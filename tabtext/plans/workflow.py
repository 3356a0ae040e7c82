"""End-to-end classification workflow (the reference's fixed-parameter
entry point), composed from the operators.

Stages: ingest + joins -> ANOVA filter -> missing-data rules -> report
features -> train-median fill -> [k-fold CV diagnostics] -> fit on train /
score validation -> out-of-fold scale tuning -> validation metrics -> refit
on train + val -> scaled test predictions -> submission.

The prepared table is checkpointed once (reliable folder) and every later
stage reads it, so the CV loop neither re-runs the joins nor depends on a
long lineage. Each fit set gets vocabularies fitted on its own rows, as in
the reference; for the k folds they come from one aggregation (totals minus
the fold). CV diagnostics and OOF tuning share the k fold fits, and the
independent fits run concurrently.
"""

from __future__ import annotations

import math
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabtext.functions import text as tx
from tabtext.operators import boosting as BO
from tabtext.operators import calibrate as K
from tabtext.operators import encode as EN
from tabtext.operators import joins as J
from tabtext.operators import metrics as ME
from tabtext.operators import missing as M
from tabtext.operators import models as MO
from tabtext.operators import sampling as SA
from tabtext.operators import search as SE
from tabtext.operators import stats as ST
from tabtext.operators import tfidf as TF
from tabtext.operators import tuning as TU
from tabtext.plans import frames as FR
from tabtext.functions.hashing import hash_split
from tabtext.operators.schema import drop_exact
from tabtext.session import cut_lineage, discard
from tabtext.sources import cases as C
from tabtext.sources import files as FS
from tabtext.sources import standins as si


DEFAULT_PARAMS = {
    "rf": MO.RF_PARAMS,
    "gbt": MO.GBT_FIXED_PARAMS,
    "mlp": {},
}


@dataclass
class Settings:
    model: str = "rf"
    model_params: dict | None = None   # None: the model's defaults below
    cv_folds: int = 5
    oof_folds: int = 5
    seed: int = 42
    focus: tuple = si.FOCUS_CLASSES
    p_threshold: float = 0.05
    max_missing: float = 0.40
    indicator_missing: float = 0.10
    word: dict = field(default_factory=lambda: dict(TF.WORD_DEFAULTS))
    char: dict = field(default_factory=lambda: dict(TF.CHAR_DEFAULTS))
    run_cv: bool = True
    run_oof: bool = True
    search: dict | None = None         # budget of a parameter search (boosted trees), see search_params; None: no search
    search_cv: dict | None = None      # the same inside each fold of the CV diagnostics


@dataclass
class Prepared:
    frame: DataFrame          # one row per case, all splits, filled features
    numeric: list[str]
    categorical: list[str]
    labels: list[str]
    focus_ids: list[int]
    onehot: EN.OneHotModel
    word: TF.CountBlock
    char: TF.CountBlock
    diagnostics: dict


def fold_set(k: int, i: int) -> str:
    """Name of the fit set "labelled train + val rows outside fold i of k"."""
    return f"not {i} of {k}"


def fit_sets(s: Settings) -> dict[str, list[str]]:
    """Fit set -> its groups. A group is "split|fold" with folds over the least common multiple of the fold
    counts in use, so a fold of k is the group's fold modulo k."""
    groups = [(sp, f) for sp in ("train", "val") for f in range(math.lcm(s.cv_folds, s.oof_folds))]
    sets = {"train": [g for g in groups if g[0] == "train"], "train+val": groups}
    for k in {s.cv_folds, s.oof_folds}:
        sets.update({fold_set(k, i): [g for g in groups if g[1] % k != i] for i in range(k)})
    return {name: [f"{sp}|{f}" for sp, f in gs] for name, gs in sets.items()}


def prepare(spark: SparkSession, sf_dir: str, s: Settings) -> Prepared:
    """Stages 1-6: ingest, joins, ANOVA, missing rules, report features, fill."""
    diag: dict = {}
    # stage 1: case JSON -> rows (report, label, n_modalities), split by key
    js = C.explode_case_map(si.case_maps(spark, sf_dir).select("js_plain"), "js_plain")
    cases = js.select("case_id", hash_split(F.col("case_id")).alias("split"), "report",
                      F.col("Overall_class").alias("label"), "n_modalities")
    # clinical LEFT JOIN cases: a clinical row without a case keeps a null report and label
    clinical = si.clinical(spark, sf_dir)
    # folds of the labelled train + val cases, dealt on narrow rows before the texts are joined
    known = clinical.filter("split IN ('train', 'val')").select("case_id").distinct().join(
        cases.filter("label IS NOT NULL").select("case_id", "label"), "case_id")
    known = known.groupBy("case_id").agg(F.min("label").alias("label"))
    folds = SA.stratified_folds(known, math.lcm(s.cv_folds, s.oof_folds), s.seed).select("case_id", "fold")
    clinical = clinical.join(folds, "case_id", "left")
    frame = J.join_clinical(clinical, cases.drop("split")).join(FR.radiomics_merged(spark, sf_dir), "case_id", "left")
    frame = cut_lineage(frame)  # the statistics passes below all read the joined rows
    t = time.time()
    rad = FR.RAD_COLS
    train = frame.filter("split = 'train'")
    # ANOVA filter on labelled train rows (before the missing-rate filter)
    n_labels = train.filter("label IS NOT NULL").select("label").distinct().count()
    long = M.to_long(train.select("case_id", "label", *rad), rad, ["case_id", "label"], name="feature")
    keep = ST.anova_keep(ST.anova(long), rad, s.p_threshold, n_labels)
    diag["anova_kept"], diag["anova_total"] = len(keep), len(rad)
    diag["t_anova"] = round(time.time() - t, 1)
    frame = frame.drop(*[c for c in rad if c not in set(keep)])
    # missing-rate rules on the kept radiomics
    rates = M.null_rate_map(frame.filter("split = 'train'"), keep) if keep else {}
    sparse = M.sparse_columns(rates, s.max_missing)
    frame = frame.drop(*sparse)
    kept = [c for c in keep if c not in set(sparse)]
    ind = M.indicator_columns({c: rates[c] for c in kept}, s.indicator_missing)
    frame = M.add_missing_indicators(frame, ind)
    diag["dropped_sparse"], diag["indicators"] = len(sparse), len(ind)
    # report features, then the fill with train medians ('Sex' is dropped by
    # exact name first, as in the reference)
    frame = tx.add_report_features(frame, "report")
    frame = drop_exact(frame, ["Sex"])
    exclude = {"case_id", "split", "label", "report", "fold"}
    categorical = [c for c, t in frame.dtypes if t == "string" and c not in exclude]
    numeric = [c for c, t in frame.dtypes if t != "string" and c not in exclude]
    t = time.time()
    meds = M.median_map(frame.filter("split = 'train'"), numeric)
    diag["t_medians"] = round(time.time() - t, 1)
    frame = M.fill_missing(frame, meds, categorical, "report")
    labels = EN.fit_labels(frame.filter("split IN ('train', 'val')"))
    frame = EN.encode_labels(frame, labels, "label", "y")
    # vocabularies of all fit sets, then one count vector per case over their union; the text ends here
    known = frame.filter("fold IS NOT NULL").select("case_id", "report", F.concat_ws("|", "split", "fold").alias("grp"))
    blocks = [TF.CountBlock(n, TF.fit_tfidf_sets(known, "grp", fit_sets(s), "report", "case_id", name=n, **kw))
              for n, kw in (("word", s.word), ("char", s.char))]
    for b in blocks:
        frame = b.count(frame, "report")
    frame = cut_lineage(frame.drop("report"))
    onehot = EN.fit_one_hot(frame.select(*numeric, *categorical))
    return Prepared(frame, numeric, categorical, labels, EN.focus_ids(labels, s.focus), onehot, *blocks, diag)


def featurize(p: Prepared, fit_set: str, rows: DataFrame) -> DataFrame:
    """[tabular one-hot | word TF-IDF | char TF-IDF] with the vocabularies of ``fit_set``; adds ``features``."""
    x = p.onehot.transform(rows, "tab")
    x = p.char.transform(p.word.transform(x, fit_set), fit_set)
    return EN.assemble(x, ["tab", "word", "char"], "features").drop("tab", "word", "char", "word_counts", "char_counts")


def fit_features(p: Prepared, fit_set: str, fit_rows: DataFrame, score_rows: DataFrame, s: Settings,
                 seed: int) -> tuple[DataFrame, DataFrame]:
    """Fit rows (focus classes upsampled, weighted) and score rows with ``features``. One featurize pass over
    both; a flag (not a join on the key) tells them apart afterwards."""
    both = fit_rows.withColumn("_fit", F.lit(True)).unionByName(score_rows.withColumn("_fit", F.lit(False)))
    feats = cut_lineage(featurize(p, fit_set, both).select("case_id", "split", "label", "y", "features", "_fit"))
    tr = SA.upsample_wide(feats.filter("_fit").drop("_fit"), [p.labels[i] for i in p.focus_ids], seed=seed)
    return SA.balanced_weights(tr, "label", "weight"), feats.filter(~F.col("_fit")).drop("_fit")


def fit_score(p: Prepared, fit_set: str, fit_rows: DataFrame, score_rows: DataFrame, s: Settings,
              seed: int, search: dict | None = None) -> DataFrame:
    """Featurize, upsample the focus classes of the fit rows, weight, fit,
    and return ``score_rows`` with ``p`` / ``pred``. With ``search`` the parameters are searched on these rows first."""
    tr, sc = fit_features(p, fit_set, fit_rows, score_rows, s, seed)
    if search:
        found = best_params(search_params(tr, sc, len(p.labels), p.focus_ids, seed, **{"name": fit_set, **search}))
        s = replace(s, model="gbt", model_params=found)
    params = dict(s.model_params if s.model_params is not None else DEFAULT_PARAMS[s.model])
    if s.model == "mlp":
        params["n_features"] = len(tr.first()["features"])
    model = MO.fit_classifier(tr, s.model, len(p.labels), params)
    return model.predict(sc).select("case_id", "split", "label", "y", "p", "pred")


def search_params(tr: DataFrame, sc: DataFrame, n_classes: int, focus: list[int], seed: int, n_trials: int = SE.TRIALS,
                  n_init: int = SE.INIT_TRIALS, width: int = 1, name: str = "", folder: str | None = None) -> DataFrame:
    """Ledger of a search over ``tuning.BOUNDS``; a trial's score is the blend of a boosted fit on ``tr`` over the
    labelled rows of ``sc``, with all rounds that the trial's parameters name. Rows are binned once for all trials."""
    tr, sc = cut_lineage(tr), cut_lineage(sc.filter("y IS NOT NULL"))
    data = BO.prepare(tr, n_classes, "features", "y", "weight", MO.row_key(tr))

    def objective(params: dict) -> float:
        model = BO.fit_boosted(tr, n_classes, dict(params, random_state=seed), data=data)
        pred = MO.predict_proba(model, sc, n_classes).select("y", "pred")
        return float(ME.summary(ME.confusion(pred), [], focus).first()["blend"])

    out = SE.model_search(tr.sparkSession, objective, n_trials, n_init, seed, width=width, name=name, folder=folder)
    discard(data.blocks)
    return out


def best_params(ledger: DataFrame) -> dict:
    """The parameters of a search's best trial, as the model takes them."""
    return {k: v for k, v in TU.normalize_params(ledger.filter("best = 1").select(*TU.BOUNDS)).first().asDict().items()}


def _labelled(frame: DataFrame, *splits: str) -> DataFrame:
    return frame.filter(F.col("split").isin(*splits) & F.col("y").isNotNull())


def kfold(p: Prepared, rows: DataFrame, k: int, s: Settings, workers: int | None = None,
          search: dict | None = None) -> tuple[DataFrame, list[float]]:
    """Stratified k folds; each fold scored by a model fitted without
    it. Returns the out-of-fold scores and per-fold blend after per-fold
    scale tuning. Folds are independent jobs submitted concurrently from
    driver threads (the scheduler interleaves their stages)."""
    rows = rows.withColumn("fold", F.col("fold") % k)

    def one(i: int):
        fit_rows, val_rows = rows.filter(F.col("fold") != i), rows.filter(F.col("fold") == i)
        scored = cut_lineage(fit_score(p, fold_set(k, i), fit_rows, val_rows, s, s.seed + i + 1, search))
        scales, _, _ = K.tune_scales(scored, len(p.labels), p.focus_ids)
        pred = scored.select("y", K.argmax(K.apply_scales(F.col("p"), scales)).alias("pred"))
        blend = float(ME.summary(ME.confusion(pred), [], p.focus_ids).first()["blend"])
        return scored.withColumn("fold", F.lit(i)), blend

    with ThreadPoolExecutor(max_workers=workers or k) as ex:
        res = list(ex.map(one, range(k)))
    oof = res[0][0]
    for o, _ in res[1:]:
        oof = oof.unionByName(o)
    return oof, [b for _, b in res]


def run(spark: SparkSession, sf_dir: str, s: Settings | None = None) -> dict:
    """The whole workflow; returns DataFrames and diagnostics."""
    s = s or Settings()
    t0 = time.time()
    timings: dict[str, float] = {}
    p = prepare(spark, sf_dir, s)
    timings["prepare"] = time.time() - t0
    out: dict = {"diagnostics": p.diagnostics, "labels": p.labels, "focus_ids": p.focus_ids}
    cv_rows = _labelled(p.frame, "train", "val")
    if s.search:  # train fits, validation scores; the best trial's parameters serve all later fits
        t = time.time()
        tr, sc = fit_features(p, "train", _labelled(p.frame, "train"), _labelled(p.frame, "val"), s, s.seed)
        ledger = search_params(tr, sc, len(p.labels), p.focus_ids, s.seed, **s.search)
        out["trials"], found = ledger, best_params(ledger)
        out["best_params"] = found
        timings["search"] = time.time() - t
        s = replace(s, model="gbt", model_params=found)

    # CV diagnostics, the validation fit, the OOF folds and the final refit
    # are independent: run them concurrently. CV and OOF use the same folds
    # (same seed, rows, parameters and upsampling seeds), i.e. the same fits,
    # so with equal fold counts the k fits are made once and serve both.
    shared = s.run_cv and s.run_oof and s.cv_folds == s.oof_folds and not s.search_cv

    def cv():
        return kfold(p, cv_rows, s.cv_folds, s, search=s.search_cv)[1]

    def cv_and_oof():
        oof, blends = kfold(p, cv_rows, s.cv_folds, s)
        return blends, K.tune_scales(cut_lineage(oof), len(p.labels), p.focus_ids)

    def val_fit():
        v = cut_lineage(fit_score(p, "train", _labelled(p.frame, "train"), _labelled(p.frame, "val"), s, s.seed))
        return v, K.tune_scales(v, len(p.labels), p.focus_ids)

    def oof_fit():
        oof, _ = kfold(p, cv_rows, s.oof_folds, s)
        return K.tune_scales(cut_lineage(oof), len(p.labels), p.focus_ids)

    def final_fit():
        return cut_lineage(fit_score(p, "train+val", _labelled(p.frame, "train", "val"),
                                     p.frame.filter("split = 'test'"), s, s.seed))

    t = time.time()
    with ThreadPoolExecutor(max_workers=4) as ex:
        f_both = ex.submit(cv_and_oof) if shared else None
        f_cv = ex.submit(cv) if s.run_cv and not shared else None
        f_val = ex.submit(val_fit)
        f_oof = ex.submit(oof_fit) if s.run_oof and not shared else None
        f_final = ex.submit(final_fit)
        val, (val_scales, val_score, _) = f_val.result()
        test = f_final.result()
        out["val_scales"], out["val_tuned_score"] = val_scales, val_score
        scales = val_scales
        if f_both is not None:
            out["cv_scores"], (scales, oof_score, _) = f_both.result()
            out["oof_scales"], out["oof_score"] = scales, oof_score
        if f_cv is not None:
            out["cv_scores"] = f_cv.result()
        if f_oof is not None:
            scales, oof_score, _ = f_oof.result()
            out["oof_scales"], out["oof_score"] = scales, oof_score
    timings["fits"] = time.time() - t
    vpred = val.select("y", K.argmax(K.apply_scales(F.col("p"), scales)).alias("pred"))
    conf = ME.confusion(vpred)
    out["val_metrics"] = ME.summary(conf, [], p.focus_ids)
    out["class_report"] = ME.class_report(conf)
    out["scales"] = {p.labels[i]: float(scales[i]) for i in p.focus_ids}
    test = test.withColumn("pred", K.argmax(K.apply_scales(F.col("p"), scales)))
    test = EN.decode_labels(test, p.labels, "pred", "pred_label")
    out["submission"] = FS.submission(test, "case_id", "pred_label", "Overall_class")
    out["timings"] = timings
    return out
