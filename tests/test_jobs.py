"""The command-line jobs, one after the other, over captured messages."""

import pytest

from catalog import inputs
from claimwright.jobs import main, parser
from tests.conftest import SF


def test_jobs_in_order(spark, tmp_path, capsys):
    raw, out, table = str(tmp_path / "raw"), str(tmp_path / "out"), "job_check.claim_features"
    main(["ingest", "--captured", inputs.captured_path(spark, SF), "--raw", raw,
          "--checkpoint", str(tmp_path / "checkpoint"), "--once"], spark)
    main(["features", "--raw", raw, "--output", out, "--table", table], spark)
    main(["report", "--output", out, "--table", table], spark)
    main(["benchmark", "--table", table], spark)
    shown = capsys.readouterr().out
    assert "fraud_pct" in shown and "provider_anomaly_summary" in shown and "avg_amount" in shown
    assert spark.table(table).count() == inputs.claims(spark, SF).count()
    assert (tmp_path / "out" / "reports" / "region_fraud_patterns").is_dir()


def test_arguments():
    args = parser().parse_args(["ingest", "--servers", "broker:9092", "--raw", "r", "--checkpoint", "c"])
    assert (args.topic, args.trigger, args.offsets_per_trigger) == ("health_insurance_claims", "30 seconds", 5000)
    with pytest.raises(SystemExit):
        parser().parse_args(["retrain", "--output", "o"])
