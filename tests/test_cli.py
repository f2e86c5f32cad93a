"""The command line runs the analyses and the generator on the current session."""

from cartwheel.__main__ import main
from cartwheel.sources.io import read_table


def test_cli_analytics_and_generate(spark, tmp_path, capsys):
    out = str(tmp_path / "processed")
    assert main(["analytics", "--sf-dir", "/root/testdata/sf0.001", "--out", out]) == 0
    assert read_table(spark, f"{out}/top_customers").count() == 10
    assert main(["generate", "--out", str(tmp_path / "raw"), "--customers", "30",
                 "--products", "5", "--orders", "100"]) == 0
    assert "orders" in capsys.readouterr().out


def test_cli_formats_and_timed(spark, tmp_path, capsys):
    assert main(["formats", "--table", "/root/testdata/sf0.001/events.parquet",
                 "--out", str(tmp_path / "bench")]) == 0
    out = capsys.readouterr().out
    assert "size_savings_%" in out and "Smallest File" in out
    assert main(["timed", "--sf-dir", "/root/testdata/sf0.001"]) == 0
    out = capsys.readouterr().out
    assert "Top Customers" in out and "total_seconds" in out
