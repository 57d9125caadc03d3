from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from filingfold.session import build_session, ensure_checkpoint_dir

    s = build_session(master="local[*]", shuffle_partitions=8, app="filingfold-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
