from tests.conftest import spark, tmp_dir  # noqa: F401
