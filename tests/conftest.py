import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for p in (ROOT, os.path.dirname(os.path.abspath(__file__))):
    if p not in sys.path:
        sys.path.insert(0, p)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from surveyframe.session import get_spark

    s = get_spark("local[*]", app="surveyframe-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def survey_small(spark):
    from surveyframe.plans.consolidate import survey

    return survey(spark, SF_SMALL).persist()
