import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from revmart.session import build_session

    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def local_frame(spark, rows, ddl):
    """A frame the planner knows the size of (rows handed over as an Arrow table)."""
    schema = StructType.fromDDL(ddl)
    table = pa.Table.from_pylist([dict(zip(schema.names, row)) for row in rows], schema=to_arrow_schema(schema))
    return spark.createDataFrame(table)
