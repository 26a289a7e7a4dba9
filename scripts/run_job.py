"""Launcher for spark-submit: ``spark-submit ... scripts/run_job.py <job args>``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sessionmetrics.plans.job import main  # noqa: E402

if __name__ == "__main__":
    main()
