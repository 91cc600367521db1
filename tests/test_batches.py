"""A batch of postings written as text and read again."""

from types import SimpleNamespace

from leadtide.plans import queries_table
from leadtide.sources.batches import typed
from tests.helpers import raw


def test_batch_of_text_is_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries_table, "new_path", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(queries_table, "LINES_PER_FILE", 3)
    odd = [{"title": 'a "quoted"\nline'}, {"title": "é中\U0001f600"}, {"location": None, "url": ""}, {"posting_date": None}]
    postings = raw(spark, *odd, *[{} for _ in range(6)]).coalesce(1)
    got = typed(queries_table.text_batch(SimpleNamespace(spark=spark, postings=postings)))
    same = postings.drop("last_scraped_at").withColumnRenamed("first_scraped_at", "scraped_at")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, same.collect()))
    files = list((tmp_path / "batch").glob("part-*"))
    assert len(files) == 4 and all(f.name.endswith(".json.gz") for f in files)
