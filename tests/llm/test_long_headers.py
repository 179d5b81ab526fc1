"""Archives whose record headers are longer than any block that is read at a time."""

import pytest

from callweave.llm import warc
from callweave.llm.common import stages


@pytest.mark.parametrize("range_bytes", [3000, 4 << 20])
def test_a_very_long_url_hides_no_page(spark, range_bytes):
    rows = [(i, f"http://a.example.com/{i}", f"page {i} " * 50) for i in range(40)]
    rows[5] = (5, "http://a.example.com/" + "x" * 200_000, "long")
    rows[17] = (17, "http://a.example.com/" + " \x01é" * 30_000, "escaped")
    # Magics in a payload, the last with a header that ends nowhere near.
    rows[20] = (20, "u", ("WARC/1.0\r\na: b\r\n" * 300) + "c: d\r\n" * 30_000)
    folder = stages(spark).folder
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    assert spark.read.parquet(f"{folder}/list").count() <= 4
    got = {int(r.record_id): (r.uri, r.payload.decode()) for r in warc.read_archives(spark, folder, True, range_bytes).collect()}
    assert sorted(got) == list(range(40))
    assert got[5][0] == rows[5][1] and got[17][0] == "http://a.example.com/" + "%20%01é" * 30_000
    assert all(got[i][1] == html for i, _, html in rows)
