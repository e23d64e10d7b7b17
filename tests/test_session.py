import os

from orderloom import session as S


def test_intermediate_tables_are_kept_in_the_shared_folder_and_released(spark):
    df = S.materialize(spark.range(5), "kept")
    assert df.count() == 5 and S.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    folder = os.path.join(S.shared_dir(spark), "orderloom", spark.sparkContext.applicationId)
    assert os.listdir(folder)
    # other tests' inputs live in the same folder, so release another application's view of it
    own, S._own_dir = S._own_dir, lambda s: folder + "-other"
    try:
        path = S.fresh_path(spark, "x")
        spark.range(1).write.parquet(path)
        S.release(spark)
        assert not os.path.exists(folder + "-other")
    finally:
        S._own_dir = own
