import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from tradewind.session import local_session
    session = local_session("tradewind-tests", cores=8, shuffle_partitions=2, conf={
        # the tables are tiny: compiling a plan takes longer than interpreting it
        "spark.sql.codegen.wholeStage": "false", "spark.default.parallelism": "2"})
    yield session
    session.stop()
