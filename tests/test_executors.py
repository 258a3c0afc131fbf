"""Python tasks must run where the package is not installed."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from usagetide.session import build_session
spark = build_session("away", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
from pyspark.sql import functions as F
from usagetide.operators import attribution, matching, scoring
units = spark.range(40).select(
    F.col("id").alias("company_id"), (F.col("id") / 40).alias("propensity_score"), (F.col("id") % 2 == 0).alias("is_treatment")
)
assert matching.caliper_match(units, caliper=0.1).count() > 0
rows = spark.range(60).select(
    F.format_string("c%d", "id").alias("company_id"), F.lit("A").alias("industry"), F.lit("Growth").alias("contract_tier"),
    (F.col("id") % 3 == 0).alias("hard_churn_label"),
    *[((F.col("id") * (k + 3)) % 17).cast("double").alias(c) for k, c in enumerate(scoring.NUMERIC_FEATURES)],
)
model = scoring.train_churn_model(rows, trees=2)
assert attribution.attribution(model, scoring.feature_matrix(rows)).count() == 60
print("fine")
"""


def test_tasks_do_not_import_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240,
    )
    assert "fine" in done.stdout, done.stderr[-2000:]
