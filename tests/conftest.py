import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from evidentia.session import local_session
    warehouse = tempfile.mkdtemp(prefix="evidentia-warehouse-")
    s = local_session(cores=4, shuffle_partitions=8, app="evidentia-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def parse_one(spark):
    """Parse one reply text into a dict of the 27 coded columns."""
    from evidentia.operators.coding import coded_rows

    def run(text, title="Paper"):
        df = spark.createDataFrame([(1, title, text)], "doc_id long, title string, response string")
        row = coded_rows(df, response="response", title="title").collect()[0].asDict()
        row.pop("doc_id")
        return row
    return run
