"""Session settings of the shelf queries and of the training-data operators."""

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()


def test_shelf_queries_scan_small_pieces(spark, sf_dir):
    for name, size in (("g13_top_profile", 32 << 20), ("op13_vector_codes", 128 << 20),
                       ("g13_top_profile", 32 << 20)):
        QUERIES[name](spark, sf_dir)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b") == str(size)
