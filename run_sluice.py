"""spark-submit launcher: spark-submit --py-files sluice.zip run_sluice.py config.yml LANDING [OUTPUT]"""

import sys

from sluice.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
