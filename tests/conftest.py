from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlake.session import ensure_checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("orderlake-tests", cores="4", partitions=8)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="orderlake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def lake_root():
    return tempfile.mkdtemp(prefix="orderlake-lake-")
