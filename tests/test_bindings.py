"""How the rows of the tables are dealt out."""

from leadtide.sources import bindings


def test_large_pieces_are_dealt_out(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "lineitem.parquet")
    spark.range(1000, numPartitions=1).write.parquet(path)
    df = spark.read.parquet(path)
    size = bindings.folder_size(spark, path)
    assert size > 1000
    cores = spark.sparkContext.defaultParallelism
    assert bindings.dealt(df, path, "id").rdd.getNumPartitions() == cores  # small: as before
    monkeypatch.setattr(bindings, "LARGE_PIECE", size // 2 // df.rdd.getNumPartitions())
    monkeypatch.setattr(bindings, "SMALL_PIECE", size // 20)
    many = bindings.dealt(df, path, "id")
    assert many.rdd.getNumPartitions() > cores
    assert sorted(r.id for r in many.collect()) == list(range(1000))
