from __future__ import annotations

from conftest import SMALL
from skytracks.__main__ import main
from skytracks.plans import fixtures
from skytracks.plans.pipeline import Lake, run
from skytracks.session import build_session, cut_lineage, fresh_dir, shared_dir
from skytracks.sources.lake import read_bronze, read_silver


def test_whole_run(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    fixtures.snapshot_documents(spark, SMALL).coalesce(1).write.text(landing)
    done = run(spark, root, landing, mode="full", one_per_line=True, with_training=True, table="t_run")
    lake = Lake(root)
    assert done == {
        "bronze": lake.bronze, "silver": lake.silver, "models": lake.models,
        "predictions": lake.predictions, "gold": lake.gold,
    }
    assert read_bronze(spark, lake.bronze).count() == 1060
    silver = read_silver(spark, lake.silver).count()
    assert spark.read.parquet(lake.gold).count() == spark.table("t_run").count() == silver
    assert 0 < spark.read.parquet(lake.predictions).count() < silver

    again = run(spark, root, mode="incremental", as_of="2024-01-15T12:00:00", with_predictions=False, table="t_run")
    assert again == {"silver": lake.silver, "gold": lake.gold}
    assert read_silver(spark, lake.silver).count() == silver
    assert spark.read.parquet(lake.gold).count() == spark.table("t_run").count() == silver


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    first, second = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert first != second and first.startswith(named)
    assert cut_lineage(spark.range(3)).count() == 3


def test_joining_a_session_keeps_it_running(spark):
    assert build_session() is spark or build_session().range(1).count() == 1
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_command_line(spark, tmp_path, capsys):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    fixtures.snapshot_documents(spark, SMALL).coalesce(1).write.text(landing)
    options = ["--landing", landing, "--one-per-line", "--no-predictions", "--as-of", "2024-01-15T12:00:00"]
    done = main([root, *options, "--lookback-minutes", "600", "--lamin", "43", "--lamax", "48"])
    assert done["gold"] == Lake(root).gold and "silver:" in capsys.readouterr().out
    assert read_bronze(spark, Lake(root).bronze).filter("lat < 43 OR lat > 48").isEmpty()
    assert not read_silver(spark, Lake(root).silver).isEmpty()
