from __future__ import annotations

import pytest

from millrace.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    s = session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__checkpoint__dir=folder,
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
