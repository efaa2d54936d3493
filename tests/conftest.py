from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakelens.session import local_session

SF_SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 4)


@pytest.fixture
def lake_file(tmp_path):
    """Writes a text file below a temporary folder and returns its path."""

    def write(name: str, content: str, folder: str = "") -> str:
        target = tmp_path / folder / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content.encode())
        return str(target)

    return write


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
