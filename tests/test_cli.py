"""End to end through the command line: raw files -> normalised readings ->
result tables -> a serving query."""

from cirrus.__main__ import load_results, main
from tests.test_raw_source import _write


def test_cli_end_to_end(spark, tmp_path, capsys):
    _write(tmp_path, "1901", "02907099999", 30)
    data, norm, res = str(tmp_path / "data"), str(tmp_path / "norm"), str(tmp_path / "res")
    main(["normalize", "--data-dir", data, "--out", norm])
    main(["analytics", "--normalized", norm, "--results", res])
    tables = load_results(spark, res)
    assert sorted(tables) == sorted(f"uc{i:02d}" for i in range(1, 11))
    # 30 readings over 24 distinct hours: 6 pairs share a time and emit no rate
    assert tables["uc01"].count() > 0 and tables["uc03"].count() == 23
    main(["serve", "--results", res, "--query", "s01", "--from", "1900-12-31 00:00:00", "--to", "1901-01-03 00:00:00"])
    assert "029070-99999" in capsys.readouterr().out
