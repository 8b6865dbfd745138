import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.fixture(scope="session")
def spark():
    from sluice.session import local_session, scratch_dir

    s = local_session("*", 8, app="sluice-tests")
    scratch_dir(s)  # tests set their own checkpoint dir when the session has none
    yield s
    s.stop()


@pytest.fixture()
def landing():
    """A fresh landing root per test, with a helper to write files under it."""
    root = tempfile.mkdtemp(prefix="sluice-landing-")

    def write(rel: str, content, binary: bool = False):
        path = os.path.join(root, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        if binary:
            with open(path, "wb") as fh:
                fh.write(content)
        else:
            with open(path, "w", encoding="utf-8", newline="") as fh:
                fh.write(content)
        return path

    write.root = root
    return write


def rules(name: str, **kw):
    from sluice.rules import TableRules

    return TableRules.load(os.path.join(FIXTURES, "rules", f"{name}.json"), **kw)
