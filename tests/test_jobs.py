from ledgerline.operators import labels as L
from ledgerline.plans import jobs
from samples import media_df


def test_jobs_end_to_end(spark, store):
    media = media_df(spark)
    store.write(media, "atp", "media")
    store.create("atp", "training", L.sync_target_schema(media.schema))
    root = store.root
    rows = jobs.main(["--root", root, "sync"], spark=spark)
    assert rows[0]["status"] == "success" and rows[0]["rows"] == 2
    rows = jobs.main(["--root", root, "review"], spark=spark)
    assert rows[0]["rows"] == 2
    assert {r.reviewed for r in store.read("atp", "training").collect()} == {True}
    rows = {r["source"]: r for r in jobs.main(["--root", root, "backup", "--date", "20250101"], spark=spark)}
    assert rows["atp.media"]["status"] == "success" and rows["atp.prediction"]["status"] == "failed"
    store.truncate("atp", "training")
    rows = {r["target"]: r for r in jobs.main(["--root", root, "reload", "--tables", "training"], spark=spark)}
    assert rows["atp.training"]["rows"] == 2
    assert jobs.main(["--root", root, "sync"], spark=spark)[0]["rows"] == 0
