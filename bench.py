"""Headline timings as one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores.
Every timed item runs to the end through a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from inkprint import constants as K  # noqa: E402
from inkprint.operators import features as ft, models  # noqa: E402
from inkprint.plans import catalog, fixtures as fx  # noqa: E402
from inkprint.session import build_session, release  # noqa: E402

QUERIES = [
    "strip_comments", "data_summary", "leakage_audit", "split_audit", "augmentation_effect",
    "word_tokens", "vocab_topk", "tfidf_word", "naive_bayes", "robustness_eval",
    "chunk_predict", "model_metrics", "ablation_change", "study_conditions", "match_category",
    "incremental_scoring",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__driver__memory="16g", spark__ui__enabled="false",
        spark__sql__shuffle__partitions=str(2 * int(cpus)), spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set(fx.SPREAD, str(2 * int(cpus)))  # the table is one small file
    seconds: dict[str, float] = {}

    def timed(name: str, action):
        started = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
        return result

    run(fx.table(spark, sf_dir, "documents"))  # session and file system warm-up, not timed

    train = fx.split_programs(spark, sf_dir).where("split = 'train'")
    model = timed("char_tfidf_fit_50k", lambda: ft.fit_tfidf(train, "char", max_features=K.CHAR_FEATURES))
    sparse = model.transform(fx.split_programs(spark, sf_dir), carry=["label", "split"])
    stored = timed("char_tfidf_transform_50k", lambda: ft.as_vectors(sparse, model.size, partition_by=["split"]))
    part = stored.where("split = 'train'")
    n_rows = part.count()
    timed("naive_bayes_fit_50k", lambda: models.fit(part, fx.LANGS, "Naive Bayes", n_rows, model.size))
    timed("linear_svm_fit_50k", lambda: models.fit(part, fx.LANGS, "Linear SVM", n_rows, model.size))
    limited = timed("char_tfidf_fit_500", lambda: ft.fit_tfidf(train, "char", max_features=K.LIMITED_FEATURES))
    small = limited.transform(fx.split_programs(spark, sf_dir), carry=["label", "split"])
    stored = timed("char_tfidf_transform_500", lambda: ft.as_vectors(small, limited.size, partition_by=["split"]))
    part = stored.where("split = 'train'")
    for name in models.MODEL_NAMES:
        fitted = timed(f"fit_500 {name}", lambda: models.fit(part, fx.LANGS, name, n_rows, limited.size))
        timed(f"predict_500 {name}", lambda: run(models.predict(fitted, stored.where("split <> 'train'"), fx.LANGS)))

    for name in QUERIES:
        timed(name, lambda: run(catalog.QUERIES[name](spark, sf_dir)))

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("/", 1)[-1].removeprefix("sf"),
    }))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
