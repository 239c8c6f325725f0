"""spark-submit entry point for the classifier experiments.

    zip -r sparkfeat.zip sparkfeat
    spark-submit --py-files sparkfeat.zip run_experiment.py \
        --dataset_directory DIR --experiment {class_weight,scaling,pca} [--format csv] [--output DIR]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkfeat.plans.cli import main  # noqa: E402

if __name__ == "__main__":
    main()
