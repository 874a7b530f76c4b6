import json
import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakenorm.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app="lakenorm-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakenorm-tests-"))
    yield s
    s.stop()


@pytest.fixture
def jsonl(spark, tmp_path):
    """Write JSON lines (dicts or raw strings) and read them with inference."""
    def make(lines, partitioned: dict | None = None):
        root = tmp_path / f"t{uuid.uuid4().hex[:8]}"
        if partitioned:
            for dt, rows in partitioned.items():
                d = root / f"dt={dt}"
                d.mkdir(parents=True)
                (d / "part-0.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
            return str(root)
        root.mkdir(parents=True)
        (root / "part-0.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in lines))
        return spark.read.json(str(root))
    return make
