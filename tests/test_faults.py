"""Inputs that must fail or give the right rows, not wrong ones."""

import numpy as np
import pyarrow as pa
import pytest

from lociframe.functions import text as X
from lociframe.operators import regression as R
from lociframe.sources import genotypes


def test_index_over_the_files_of_a_folder(spark, tmp_path):
    for part, names in (("b.txt", "cd"), ("a.txt", "ab")):
        (tmp_path / part).write_text("".join(f"1:1_{n}\trs{n}\t{i + 1}\tA\tG\t0.1\tA\t0.9\n" for i, n in enumerate(names)))
    rows = genotypes.read_variant_info(spark, str(tmp_path), with_index=True).collect()
    assert sorted(r.variant_index for r in rows) == [0, 1, 2, 3]
    by_id = {[str(v)[-1] for v in r if str(v).startswith("rs")][0]: r.variant_index for r in rows}
    assert by_id == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_a_sample_without_sex_keeps_its_place(spark, tmp_path):
    (tmp_path / "x.sample").write_text("ID_1 ID_2 missing sex\n0 0 0 D\n11 11 0 1\n12 12 0 \n13 13 0 2\n")
    rows = genotypes.read_sample_file(spark, str(tmp_path / "x.sample"), with_index=True).collect()
    assert sorted((r.sample_id, r.sample_sex) for r in rows) == [(11, 1), (12, None), (13, 2)]
    at = {r.sample_id: r.sample_index for r in rows}
    assert at[12] - at[11] == 1 and at[13] - at[12] == 1


def table(pos, width=None):
    n = len(pos)
    calls = {"contig": ["1"] * n, "variant_index": pa.array([0] * n, pa.int64()), "dosage": pa.array([1.0] * n, pa.float64())}
    if width:
        return pa.table(calls | {"dosage": pa.array([np.zeros(width, "<f4").tobytes()] * n, pa.binary())})
    return pa.table(calls | {"pos": pa.array(pos, pa.int32())})


@pytest.mark.parametrize("samples", [2, 4000])  # made dense and added up by rows
def test_two_calls_of_a_sample_fail(samples):
    with pytest.raises(ValueError, match="more than one call"):
        R._sparse_sums(table([1, 1]), np.ones((samples, 1)), np.ones((samples, 1)))


def test_blocks_of_another_width_fail():
    with pytest.raises(ValueError, match="samples wide"):
        R._dense_sums(table([0], width=128), np.ones((64, 1)), np.ones((64, 1)))


def test_participant_names_are_parsed():
    assert X.participant_field("31-0.0") == "x31_0_0" and X.participant_header("x31_0_0") == "31-0.0"
    for bad in ("31", "a-0.0", "31-0.0.1"):
        with pytest.raises(ValueError, match="field-instance"):
            X.participant_field(bad)
