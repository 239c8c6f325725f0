"""sparkfeat: incident feature engineering and classifier comparison on Spark.

Subpackages
-----------
sources    scans and sinks (parquet / CSV / any reader), test-table adapter
functions  column expressions (dates, times, flags, rules)
operators  DataFrame -> DataFrame operators (bins, counts, metrics, ML stages)
plans      composite jobs (feature job, experiments, CLI)
streaming  the feature job applied to newly arriving incident files
"""

__version__ = "0.1.0"

from .plans.experiments import run_experiment  # noqa: E402
from .plans.features import (apply_feature_stats, engineer_features, features_fit_on_train,  # noqa: E402
                             fit_feature_stats, load_feature_stats, save_feature_stats)
from .session import build_session, checkpoint_dir, configure  # noqa: E402
from .sources.incidents import read_incidents  # noqa: E402

__all__ = ["run_experiment", "apply_feature_stats", "engineer_features", "features_fit_on_train",
           "fit_feature_stats", "load_feature_stats", "save_feature_stats", "build_session",
           "checkpoint_dir", "configure", "read_incidents"]
