"""The entry points with and without the operators for training text, and the whole job with every kind of model."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from brimline.operators.models import REGISTRY
from brimline.plans import catalog
from brimline.settings import DEFAULT_MODEL

ROOT = Path(__file__).resolve().parent.parent
SAY = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def copied(to):
    shutil.copytree(ROOT / "brimline", to / "brimline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", to)


def listed(folder):
    run = subprocess.run([sys.executable, "-B", "-c", SAY], cwd=folder, capture_output=True, text=True, check=True)
    return json.loads(run.stdout.splitlines()[-1])


@pytest.mark.parametrize("left", ["nothing", "the pipeline only", "operators without a package"])
def test_entry_without_training_text(tmp_path, left):
    copied(tmp_path)
    if left == "the pipeline only":
        (tmp_path / "corpus_pipeline.py").write_text("from brimline.llm import toxicity\n")
    if left == "operators without a package":
        (tmp_path / "brimline/llm").mkdir()
        (tmp_path / "brimline/llm/__init__.py").write_text("")
        (tmp_path / "brimline/llm/queries.py").write_text("import a_package_that_is_not_there\n")
    names, sql = listed(tmp_path)
    assert set(names) == set(catalog.QUERIES) and set(sql) <= set(names)


def test_other_errors_are_not_hidden(tmp_path):
    copied(tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("raise ValueError('broken')\n")
    with pytest.raises(subprocess.CalledProcessError):
        listed(tmp_path)


def test_whole_job_with_trees(spark):
    """Regions that run trees, ridge and other strategies: a model for each of them and each horizon."""
    rows = {r["Dam"]: r.asDict() for r in catalog.config_report(spark, "/root/testdata/sf0.01").collect()}
    config = {r.entity: r for r in catalog.P.region_config(spark, "/root/testdata/sf0.01").collect()}
    assert set(rows) == set(config)
    assert {r["Model"] for r in rows.values()} >= {"gbt", "ridge"}
    for name, row in rows.items():
        walks = config[name].strategy == "walkfwd_expanding"
        assert row["Model"] == REGISTRY[config[name].model or DEFAULT_MODEL]
        assert row["Strategy"] == ("walkfwd_expanding" if walks else "baseline")
        made = (7, 14, 30)[: len(config[name].seq_lens or "all")]
        assert row["Test rows"] > 0 and [h for h in (7, 14, 30) if (row[f"RMSE +{h}d (%)"] or 0) > 0] == list(made)
