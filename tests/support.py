"""What several test modules share; `conftest` is no module to import from, as every test folder may have one."""

import os
from pathlib import Path

TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


def rows(df, *sort):
    got = [tuple(r) for r in df.collect()]
    return sorted(got, key=repr) if not sort else got
