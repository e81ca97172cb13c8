"""Records over many splits of one file."""

from __future__ import annotations

import re

from llm.test_warc import expected, found, pages

from lakestrata.llm import warc
from lakestrata.session import session_conf, work_dir


def test_no_task_gets_all_candidates_of_a_file(spark, monkeypatch):
    path = work_dir(spark, "warc")
    warc.write_warc(pages(spark).coalesce(1), path)
    plans = []
    stored = warc.stored

    def look(df, *more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, *more)

    monkeypatch.setattr(warc, "stored", look)
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "1k"}):
        assert found(warc.page_records(warc.read_warc(spark, path))) == expected()
    windows = re.findall(r"Window \[.*\], \[([^\[\]]*)\], \[at#", "\n".join(plans))
    assert windows and all("block#" in keys for keys in windows)
