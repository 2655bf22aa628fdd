"""spark-submit entry point: ``spark-submit --py-files blockbeam.zip scripts/ledger_jobs.py <job> ...``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from blockbeam.plans.ledger_jobs import main  # noqa: E402

if __name__ == "__main__":
    main()
