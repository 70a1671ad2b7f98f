from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest

from millrace import jobs
from millrace.plans import weather
from millrace.sources.tables import read_table
from tests.conftest import bag
from tests.test_flows import CUSTOMER, messages, reading


def test_weather_jobs(spark, tmp_path, monkeypatch):
    topic, streaming, checkpoint, data = (f"{tmp_path}/{n}" for n in ("topic", "streaming", "checkpoint", "data"))
    messages(spark, reading("Ede", "Netherlands", "2024-01-01 10:00", 4.0)).write.parquet(topic)
    for _ in range(2):
        assert jobs.main(["ingest", "--source", topic, "--to", streaming, "--checkpoint", checkpoint, "--codec", "json",
                          "--until-caught-up"]) == 0
        assert jobs.main(["prepare", "--streaming", streaming, "--data", data, "--new-keys", "keep"]) == 0
    assert read_table(spark, data).count() == 1

    published = {}
    monkeypatch.setattr(weather, "write_jdbc", lambda df, **options: published.update(options, rows=bag(df)))
    spark.conf.set("spark.postgresql_url", "jdbc:postgresql://db")
    jobs.main(["publish", "--data", data, "--database", "marts", "--table", "summary"])
    assert published["url"] == "jdbc:postgresql://db/marts" and published["table"] == "summary"
    assert published["rows"] == Counter([("Netherlands", "Ede region", "Ede", 4.0, 10.0, 1, "2024-01-01 10:00")])


def test_mart_job_reports_failures(spark, rows, tmp_path, capsys):
    customers, mart = f"{tmp_path}/customers", f"{tmp_path}/mart"
    one = ("An", "Bo", "an@x", datetime(2024, 1, 1), 0)
    rows(CUSTOMER, one).write.parquet(customers)
    assert jobs.main(["mart", "--customers", customers, "--to", mart]) == 0
    rows(CUSTOMER, ("An", "Bo", "new@x", datetime(2024, 2, 1), 0)).write.mode("append").parquet(customers)
    assert jobs.main(["mart", "--customers", customers, "--to", mart]) == 1
    assert "error: customer_sk is unique, 1 failures" in capsys.readouterr().out


def test_land_compact_and_stale_jobs(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"a": {"b": 1}}\n{"a": {"b": 2}}\n')
    old, new, listing = f"{tmp_path}/t/v1", f"{tmp_path}/t/v2", f"{tmp_path}/listing"
    assert jobs.main(["land", "--source", f"{tmp_path}/in.json", "--to", old]) == 0
    spark.conf.set(jobs.MAINTENANCE_SETTING, old)
    assert jobs.main(["compact", "--to", new]) == 0
    assert bag(read_table(spark, new).select("a.b")) == Counter([(1,), (2,)])
    assert jobs.main(["stale", "--root", f"{tmp_path}/t", "--live", new, "--to", listing, "--hours", "-1"]) == 0
    assert all("/v1/" in r.path for r in read_table(spark, listing).collect()) and read_table(spark, listing).count() == 1


def test_jobs_need_their_arguments():
    with pytest.raises(SystemExit):
        jobs.main(["prepare", "--data", "x"])
    with pytest.raises(SystemExit):
        jobs.main(["compact", "--path", "x"])
