import os

from cartspark.__main__ import main
from cartspark.sources import canonical_events, write_table


def test_all_jobs(spark, folder, capsys, monkeypatch):
    monkeypatch.setattr("cartspark.__main__.build_session", lambda name: spark)
    log = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source = write_table(canonical_events(log), f"{folder}/events", "csv")
    results = f"{folder}/results"
    main(["profile", "--input", source])
    main(["batch", "--input", source, "--output", results])
    main(["speed", "--input", source, "--output", results, "--window-minutes", "60"])
    main(["serve", "--output", results])
    main(["publish", "--input", source, "--output", f"{folder}/sent", "--limit", "7", "--format", "json"])
    places = ["--output", f"{folder}/archive", "--checkpoint", f"{folder}/checkpoint"]
    main(["archive", "--input", source, *places])
    landing = ["--input", f"{folder}/archive/records", "--input-format", "json"]
    main(["stream-windows", *landing, "--output", f"{folder}/closed", "--checkpoint", f"{folder}/c1", "--max-files", "3"])
    dead = ["--dead-letters", f"{folder}/dead"]
    main(["stream-estimates", *landing, "--output", f"{folder}/estimates", "--checkpoint", f"{folder}/c2", *dead])
    shown = capsys.readouterr().out
    assert "93.5644" in shown
    assert "records archived: 1000, rejected: 0" in shown
    assert "records sent: 7, without a key: 0" in shown
    assert spark.read.json(f"{folder}/sent").count() == 7
    assert spark.read.json(f"{folder}/archive/records").count() == 1000
    assert spark.read.parquet(f"{folder}/closed/windows").count() > 0
    assert spark.read.parquet(f"{folder}/estimates").count() > 0
    # Nothing of the jobs' own is left.
    assert not [name for name in os.listdir(results) if name.startswith("_")]
