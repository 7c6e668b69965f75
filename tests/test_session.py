from censuskit.session import recommended_conf


def test_partitions_scale_with_input():
    small = recommended_conf(10 * 2**20, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"          # two waves
    for size in (2**40, 100 * 2**40):                               # 1 and 100 TiB: 128 MiB each
        conf = recommended_conf(size, cores=1000)
        assert conf["spark.sql.shuffle.partitions"] == str(size // (128 * 2**20))
        assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
