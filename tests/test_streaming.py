from catalink.sources.catalogues import COMMON, common_schema
from catalink.streaming.micro_batch import link_stream


def test_batches_are_linked_once(spark, tmp_path, frame):
    names = {left for left, _ in COMMON.values() if left}
    schema = ", ".join(f"{n} {'long' if n == 'id' else 'string'}" for n in sorted(names)) + ", crawled_at timestamp"
    import datetime as dt

    def rows(*records):
        return frame([tuple({**dict.fromkeys(names), **r}.get(n) for n in sorted(names)) + (dt.datetime(2020, 1, r["id"]),) for r in records], schema)

    title = "Effect of salt on the growth of algae in ponds"
    right_names = sorted({right for _, right in COMMON.values() if right} | {"page_start", "page_end"})
    right = frame([tuple(7 if n == "id" else title if n == "title" else None for n in right_names)], ", ".join(f"{n} {'long' if n == 'id' else 'string'}" for n in right_names))
    right = common_schema(right, False)
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))
    rows({"id": 1, "title": title}, {"id": 2, "title": "nothing like it"}).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(schema).parquet(source)
    link_stream(stream(), right, target, checkpoint).awaitTermination()
    rows({"id": 3, "title": title}, {"id": 1, "title": title}).write.mode("append").parquet(source)
    link_stream(stream(), right, target, checkpoint).awaitTermination()
    found = spark.read.parquet(target)
    assert sorted((r["left_id"], r["right_id"], r["match_type"]) for r in found.collect()) == [(1, 7, "DUPLICATED"), (3, 7, "DUPLICATED")]
