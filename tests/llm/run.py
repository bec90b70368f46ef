"""python tests/llm/run.py FOLDER NAME...: registered queries against their SQL, outside pytest."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from tests.compare import connect, difference  # noqa: E402


def compare(spark, con, name, folder):
    from casewright.llm.queries import ORACLES, QUERIES
    got = QUERIES[name](spark, folder).toPandas()
    if name not in ORACLES:
        return f"rows only: {len(got)}"
    problem = difference(got, con.sql(ORACLES[name]).df())
    return f"DIFF {problem}" if problem else f"ok {len(got)}"


if __name__ == "__main__":
    from casewright.session import local_session
    session = local_session(8)
    for query_name in sys.argv[2:]:
        start = time.time()
        print(query_name, compare(session, connect(sys.argv[1]), query_name, sys.argv[1])[:900], round(time.time() - start, 1), flush=True)
