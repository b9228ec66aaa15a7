"""The shared folder comes from the session; a cluster without one is refused."""

import pytest

from courtside import session as S


def test_scratch_paths_live_under_the_session_checkpoint_dir(spark):
    base = S.ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = S.scratch_path(spark, "marts/x"), S.scratch_path(spark, "marts/x")
    assert a != b and a.startswith(base.rstrip("/") + "/courtside/" + S.app_id(spark))


def test_unset_checkpoint_dir_is_an_error_off_local_mode(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class NoContext:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("no context on a Connect client")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(NoContext())
