"""What the experiments keep on disk."""

import os

from sparkfeat.plans import experiments as X


def test_pca_keeps_the_projection_once(spark, monkeypatch):
    """Projected rows live in the cached parts only; the table they come from has no raw vectors."""
    written, real, seen = {}, X.materialize, []
    monkeypatch.setattr(X, "materialize", lambda df, name: written.update({name: df.columns}) or real(df, name))

    def note(train, test, **options):
        seen.append((options["k"], sorted(r["features"].size for r in train.limit(3).collect()), train.count() + test.count()))
        return [("e", "v", options["k"], "m", options["train_rows"], options["test_rows"], 0.5, 0.5, 0.1)]
    monkeypatch.setattr(X, "compare_models", note)
    rows = [(i, "AC"[i % 3 == 0], float(i % 7), float(i % 5), "uv"[i % 2]) for i in range(100)]
    df = spark.createDataFrame(rows, "FOD_ID long, FIRE_SIZE_CLASS string, x double, y double, c string")
    X.pca_experiment(df, ["c"], ["x", "y"], ks=(1, 2), fit_partitions=2)
    assert seen == [(1, [1] * 3, 100), (2, [2] * 3, 100)]
    assert "scaled_features" in written["scaled-features"] and "raw_features" not in written["scaled-features"]
    assert not any("pca_all" in columns for columns in written.values())


def test_incidents_copy_goes_once_the_features_are_written(spark, monkeypatch):
    from sparkfeat.plans import catalog as C
    from tests.conftest import SF_SMOKE

    paths, real = [], C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, name: paths.append(real(df, name)) or paths[-1])
    df, _, _ = C.model_input(spark, SF_SMOKE)
    assert paths and not any(os.path.exists(p._written_path.removeprefix("file:")) for p in paths)
    assert df.count() > 0
