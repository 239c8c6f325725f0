"""spark-submit entry point for the feature-engineering job.

    zip -r sparkfeat.zip sparkfeat
    spark-submit --py-files sparkfeat.zip run_features.py \
        --input PATH [--input_format parquet|csv|...] --output DIR [--output_format parquet|csv] \
        [--date_format yyyy-MM-dd | --date_unit julian] [--fit_on train]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkfeat.plans.cli import features_main  # noqa: E402

if __name__ == "__main__":
    features_main()
