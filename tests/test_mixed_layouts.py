"""CSV files of several layouts read as one table."""

import pytest

from casemill.sources.readers import file_layouts, scan_mixed_csv, scan_telecom_csv


def test_layouts(spark, tmp_path):
    folder = tmp_path / "OND-7" / "bank"
    folder.mkdir(parents=True)
    (folder / "SRC1_a b.csv").write_text('IBAN,Bedrag\nNL1,"1\n2"\nNL2,\n')
    (folder / "SRC2_x.csv").write_text("iban,bedrag\nNL3,5\n")
    (folder / "SRC3.csv").write_text("bedrag,iban,source_id\n7,NL4,own\n")
    (folder / "SRC4.csv").write_text("iban,bedrag\n")
    assert file_layouts(spark, str(folder)).count() == 4
    got = {r.iban: (r.bedrag, r.source_id, r.investigation_id) for r in scan_mixed_csv(spark, str(folder), ["iban"]).collect()}
    assert got == {"NL1": ("1\n2", "SRC1", "OND-7"), "NL2": (None, "SRC1", "OND-7"), "NL3": ("5", "SRC2", "OND-7"), "NL4": ("7", "own", "OND-7")}
    assert scan_telecom_csv(spark, str(folder / "SRC3.csv")).first().investigation_id == "OND-7"
    for needed, bad in ((["naam"], None), ([], "iban,iban\n1,2\n"), ([], "\nno,header\n")):
        where = folder
        if bad:
            where = tmp_path / f"bad{len(bad)}"
            where.mkdir()
            (where / "f.csv").write_text(bad)
        with pytest.raises(ValueError, match="csv"):
            scan_mixed_csv(spark, str(where), needed)
