"""Support of neighbouring reads tells for insertions where the mates lie."""

from svloom.functions import reads as R
from svloom.operators import softclip


def test_insertions_tell_where_mates_lie(spark):
    """Two mates on one chromosome, one on another, one unmapped; reads that are poor, or on the wrong side, don't count."""
    read = {"chrom": "1", "rlen": 100, "mapq": 60, "nm": 0, "tlen": 0, "mate_is_reverse": True, "is_duplicate": False, "is_unmapped": False, "mate_is_unmapped": False, "clip_left": 0, "match_len": 100, "clip_right": 0, "avg_qual": 30}
    seen = [(850, False, "2", 500, {}), (855, False, "2", 900, {}), (1010, True, "3", 70, {}), (860, False, "1", 860, {"mate_is_unmapped": True}), (850, False, "2", 100, {"mapq": 1}), (1050, False, "4", 100, {})]
    rows = [read | {"read_id": i, "pos": pos, "aend": pos + 100, "is_reverse": turned, "mate_chrom": chrom, "mate_pos": at} | more for i, (pos, turned, chrom, at, more) in enumerate(seen)]
    reads = R.with_cigar(spark.createDataFrame(rows))
    windows = spark.createDataFrame([("a", "INS", 900, 1100), ("b", "INS", 5000, 5200), ("c", "DEL", 900, 1100)], "id string, sv_type string, start_pos long, end_pos long").selectExpr("*", "'1' as chrom", "0L as other_start", "0L as other_end")
    found = softclip.with_neighbours(windows, reads, ["id"]).select("id", "neighbours", "plus", "minus", "mates").collect()
    assert sorted(map(tuple, found)) == [("a", 4, 3, 1, "-1;1;-1;49,2;2;500;950,3;1;70;120"), ("b", 0, 0, 0, ""), ("c", 0, 0, 0, None)]
