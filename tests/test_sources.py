"""Files: their order, sitemaps, array roots, days."""

import datetime
import json

import pytest

from terrane.sources import listings


@pytest.mark.parametrize("split", ["64", "1m"])
def test_place_is_the_line_number_of_all_files(spark, tmp_path, split):
    lines = [[f"{f}{i:03d}\tname {i} of file {f}" for i in range(n)] for f, n in ((1, 90), (2, 1), (3, 40), (4, 0))]
    for f, rows in enumerate(lines):
        (tmp_path / f"{f}.tsv").write_text("\n".join(["id\tname", *rows]) + "\n", encoding="utf-8-sig" if f == 0 else "utf-8")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert split == "1m" or spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        got = listings.ordered_tsv(spark, str(tmp_path), "id int, name string")
        rows = sorted(got.collect(), key=lambda r: r["place"])
        assert [r["place"] for r in rows] == list(range(131))
        assert [f"{r['id']}\t{r['name']}" for r in rows] == [x for part in lines for x in part]
        ids = listings.id_list(spark, str(tmp_path)).collect()
        text = [x for part in lines for x in ["id\tname", *part]]
        assert {r["id"]: r["place"] for r in ids} == {int(x[:4]): i for i, x in reversed(list(enumerate(text))) if x[0].isdigit()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sitemaps(spark, tmp_path):
    head = '<?xml version="1.0" encoding="UTF-8"?>\n'
    site = lambda n: f"<sitemap><loc>https://x.vn/sitemap/{n}</loc><lastmod>2024-05-01</lastmod></sitemap>"
    names = ["list-20240501-1.xml", "list-20240501-2.xml", "list-20240430-1.xml"]
    (tmp_path / "index.xml").write_text(f'{head}<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">{"".join(map(site, names + names[:1]))}<sitemap><loc> </loc></sitemap></sitemapindex>')
    (tmp_path / "c").mkdir()
    for i, n in enumerate([*names, "other-20240501.xml"]):
        urls = "".join(f"<url>\n<loc> https://x.vn/{i}/{j}?a=1&amp;b=2 </loc>{'' if j == 3 else f'<lastmod>2024-05-0{j + 1}T00:00:00Z</lastmod>'}</url>" for j in range(4))
        (tmp_path / "c" / n).write_text(f"{head}<urlset>{urls}<url><loc></loc></url></urlset>")
    args = spark, str(tmp_path / "index.xml"), str(tmp_path / "c")
    assert {r["loc"].rpartition("/")[2] for r in listings.sitemap_index(*args[:2]).collect()} == set(names)
    assert listings.sitemap_links(*args).count() == 12
    got = listings.sitemap_links(*args, named="^list-20240501-", since="2024-05-02").collect()
    assert sorted((r["sitemap"], r["loc"]) for r in got) == [(names[i], f"https://x.vn/{i}/{j}?a=1&b=2") for i in (0, 1) for j in (1, 2)]
    xml = spark.createDataFrame([(1, (tmp_path / "c" / names[0]).read_text()), (2, "no xml"), (3, None), (4, "<urlset></urlset>")], "id int, xml string")
    assert sorted((r["id"], r["loc"]) for r in listings.links_of_xml(xml, "xml").collect()) == [(1, f"https://x.vn/0/{j}?a=1&b=2") for j in range(4)]


def test_array_root(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "name": "x"}, {"id": 2}]))
    (tmp_path / "b.json").write_text(json.dumps([{"id": 3, "name": "y", "other": 1}]))
    got = listings.json_feed(spark, str(tmp_path), "id int, name string", root=None)
    assert sorted((r["id"], r["name"]) for r in got.collect()) == [(1, "x"), (2, None), (3, "y")]


def test_day_dump(spark, tmp_path):
    at = datetime.datetime(2024, 5, 1)
    rows = [(1, at), (2, at + datetime.timedelta(hours=23, minutes=59)), (3, at + datetime.timedelta(days=1)), (4, at - datetime.timedelta(seconds=1)), (5, None)]
    listings.write_day(spark.createDataFrame(rows, "id int, at timestamp"), str(tmp_path / "d"), "at", "2024-05-01")
    assert sorted(r["id"] for r in spark.read.csv(str(tmp_path / "d"), header=True).collect()) == ["1", "2"]
