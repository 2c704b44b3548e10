"""spark-submit launcher: ``spark-submit --py-files letramento.zip run_job.py <job> [options]``."""

import sys

from letramento.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
