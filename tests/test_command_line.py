import datetime as dt
import glob

import pairpulse.__main__ as cli
from pairpulse.sinks.tables import Lake
from samples import land, line


def test_commands(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    prefix, landing = ["--prefix", "cli_"], str(tmp_path / "in")
    days = [dt.date(2025, 2, 1) + dt.timedelta(days=i) for i in range(28)]
    for i, day in enumerate(days):
        land(landing, day, [line(GlobalEventID=i, Day=f"{day:%Y%m%d}")])
    cli.main([*prefix, "create", "--root", str(tmp_path / "lake")])
    cli.main([*prefix, "backfill", "--landing", landing, "--start", "2025-02-01", "--end", "2025-02-28"])
    assert "months built: []" in capsys.readouterr().out
    cli.main([*prefix, "daily", "--landing", landing, "--day", "2025-02-28"])
    assert "datetime.date(2025, 2, 1)" in capsys.readouterr().out
    cli.main([*prefix, "refresh", "--start", "2025-02-27", "--end", "2025-03-01"])
    cli.main([*prefix, "stream", "--landing", landing, "--checkpoint", str(tmp_path / "ckpt")])
    assert Lake("cli_").silver.read(spark).count() == 28
    cli.main([*prefix, "export", "--folder", str(tmp_path / "out")])
    assert len(glob.glob(f"{tmp_path}/out/*.csv/*.csv")) == 1
