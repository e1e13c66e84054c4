"""Print the formatted physical plan of registered reports.

    python -m urbanpulse.plans.explain [--stored] SF_DIR REPORT [REPORT ...]

``--stored`` first materializes the lakehouse tables (the serving path) and
explains the reports over them; without it the plans start from the raw
``events`` scan.  Reports that write tables or run streams while being built
are run as part of building them.
"""

from __future__ import annotations

import os
import sys
import uuid

from urbanpulse.plans.lakehouse import Lakehouse
from urbanpulse.plans.registry import all_reports
from urbanpulse.session import checkpoint_dir, local_session


def main(argv: list[str]) -> None:
    stored = "--stored" in argv
    args = [a for a in argv if a != "--stored"]
    if len(args) < 2:
        print(__doc__)
        return
    sf_dir, names = args[0], args[1:]
    spark = local_session()
    lh = Lakehouse(spark, sf_dir)
    if stored:
        lh = lh.materialize(os.path.join(checkpoint_dir(spark), "explain", uuid.uuid4().hex[:12]))
    reports = all_reports()
    for name in names:
        print(f"===== {name} =====")
        reports[name][0](lh).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
