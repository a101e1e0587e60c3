"""Sheet readers: header normalisation, positional typing, blank cells."""

import pytest

from shiftscore.operators.leads import uncalled
from shiftscore.sources.leads import (
    malformed_rows, normalize_columns, read_call_leads, read_call_sheets, read_open_leads, read_open_sheets, snake_case)

HEADER = ("Lead Id,Source,Timestamp,Name,Mobile Number,Pickup address,Drop_address,"
          "Tentative Shifting Date,Calling Timestamp,WA_Tentative Shifting Date,A,B,C,D,E,F")


def write(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def test_snake_case_and_duplicates(spark):
    assert snake_case("House Shifting Opportunity: Created Date") == "house_shifting_opportunity_created_date"
    df = spark.createDataFrame([(1, 2, 3)], "`A b` int, `a-b` int, `Mobile` int")
    assert normalize_columns(df, {"Mobile": "mobile"}).columns == ["a_b", "a_b_2", "mobile"]


def test_call_sheet_positional_types_and_blank_cells(spark, tmp_path):
    path = write(tmp_path, "call.csv", [
        HEADER,
        '1,app,2024-01-05 10:00:00,x,9.000000001E9,Tower,Lake,2024-01-07,Call not done,NOW,,,,,,',
        '2,website,2024-01-05,x,9000000002,Tower,Lake,2024-01-08,"",,,,,,,',
        '3,website,bad,x,not a number,Tower,Lake,2024-13-40,,,,,,,,',
    ])
    df = read_call_leads(spark, path)
    rows = {r.mobile: r for r in df.collect()}
    assert set(rows) == {9000000001, 9000000002, None}
    r1 = rows[9000000001]
    assert str(r1.lead_ts) == "2024-01-05 10:00:00" and str(r1.shifting_date) == "2024-01-07"
    bad = rows[None]
    assert bad.lead_ts is None and bad.shifting_date is None       # bad cells -> NULL, no failure
    # A blank status cell is NULL and is dropped by the uncalled filter, as a
    # blank sheet cell is NA in the original; "Call not done" is kept.
    kept = {r.mobile for r in uncalled(df).collect()}
    assert 9000000001 in kept and None not in kept


def test_open_sheet(spark, tmp_path):
    path = write(tmp_path, "open.csv", [
        "Mobile,Source,Pickup Address,Drop Address,House Shifting Date,"
        "House Shifting Opportunity: Created Date,Count of order interests,Extra",
        "9000000001,app,Tower,Lake,2024-01-07,2024-01-05,3,z",
        ",,,,,,,",
    ])
    df = read_open_leads(spark, path)
    assert df.columns == ["mobile", "source", "pickup_address", "drop_address", "shifting_date",
                          "created_date", "order_interests"]
    rows = df.collect()
    assert rows[0].order_interests == 3 and rows[1].mobile is None


OPEN_DOTTED = ("Mobile,Source,Pickup.Address,Drop.Address,House.Shifting.Date,"
               "House.Shifting.Opportunity..Created.Date,Count.of.order.interests")


def test_quotes_commas_and_line_breaks_in_cells(spark, tmp_path):
    path = write(tmp_path, "open.csv", [
        OPEN_DOTTED,
        '9000000001,app,"He said ""A"", block","Line one',
        'line two",2024-01-07,2024-01-05,3',
        '9000000002,app,x,"y, z",2024-01-08,2024-01-05,2',
    ])
    rows = {r.mobile: r for r in read_open_leads(spark, path).collect()}
    assert set(rows) == {9000000001, 9000000002}
    r = rows[9000000001]
    assert r.pickup_address == 'He said "A", block' and r.drop_address == "Line one\nline two"
    assert str(r.shifting_date) == "2024-01-07" and r.order_interests == 3
    assert malformed_rows(spark, path) == 0


def test_dotted_call_headers(spark, tmp_path):
    head = HEADER.replace("Mobile Number", "Mobile.Number").replace("Calling Timestamp", "Calling.Timestamp")
    path = write(tmp_path, "call.csv", [head, "1,app,2024-01-05 10:00:00,x,9000000001,T,L,2024-01-07,Call not done,NOW,,,,,,"])
    row = read_call_leads(spark, path).collect()[0]
    assert (row.mobile, row.calling_status) == (9000000001, "Call not done")


def test_missing_column_is_an_error(spark, tmp_path):
    path = write(tmp_path, "open.csv", ["phone,Source", "9000000001,app"])
    with pytest.raises(ValueError, match="mobile"):
        read_open_leads(spark, path)


def test_malformed_rows_are_counted(spark, tmp_path):
    path = write(tmp_path, "open.csv", [OPEN_DOTTED, "9000000001,app,a,b,2024-01-07,2024-01-05,3", "9000000002,app", "9,a,b,c,d,e,f,g,h"])
    assert malformed_rows(spark, path) == 2
    assert read_open_leads(spark, path).count() == 3


def rows(df):
    return sorted(map(repr, df.collect()))


def test_sheets_with_other_orders_and_extra_columns_equal_one_sheet(spark, tmp_path):
    folder = tmp_path / "sheets"
    folder.mkdir()
    write(folder, "a.csv", [OPEN_DOTTED, "9000000001,app,Tower,Lake,2024-01-07,2024-01-05,3", "9000000002,website,A,B,2024-01-08,2024-01-05,"])
    write(folder, "b.csv", ["Source,House Shifting Date,Mobile,Remark,Drop Address,Pickup Address,Count of order interests,House Shifting Opportunity: Created Date",
                            'Whatsapp,2024-01-09,9000000003,"two\nlines",D,P,2,2024-01-06'])
    write(folder, "c.csv", [OPEN_DOTTED])                       # a header without rows
    (folder / "d.csv").write_text("")                          # an empty file
    one = write(tmp_path, "one.csv", [
        OPEN_DOTTED, "9000000001,app,Tower,Lake,2024-01-07,2024-01-05,3", "9000000002,website,A,B,2024-01-08,2024-01-05,",
        "9000000003,Whatsapp,P,D,2024-01-09,2024-01-06,2"])
    assert rows(read_open_leads(spark, str(folder))) == rows(read_open_leads(spark, one))
    assert malformed_rows(spark, str(folder)) == 0


def test_call_columns_keep_their_types_wherever_they_stand(spark, tmp_path):
    head = HEADER.split(",")
    cells = "1,app,2024-01-05 10:00:00,x,9000000001,Tower,Lake,2024-01-07,Call not done,NOW,,,,,,".split(",")
    other = [5, 7, 2, 0, 8, 9, 1, 3, 4, 6, 15, 14, 13, 12, 11, 10]
    one = write(tmp_path, "one.csv", [HEADER, ",".join(cells), ",".join(cells)])
    folder = tmp_path / "call"
    folder.mkdir()
    write(folder, "a.csv", [HEADER, ",".join(cells)])
    write(folder, "b.csv", [",".join(head[k] for k in other), ",".join(cells[k] for k in other)])
    both = read_call_leads(spark, str(folder))
    assert both.dtypes == read_call_leads(spark, one).dtypes and rows(both) == rows(read_call_leads(spark, one))
    assert both.first().lead_ts is not None


def test_the_sheet_that_lacks_a_column_is_named(spark, tmp_path):
    write(tmp_path, "good.csv", [OPEN_DOTTED, "9000000001,app,Tower,Lake,2024-01-07,2024-01-05,3"])
    write(tmp_path, "short.csv", [OPEN_DOTTED.replace("Mobile,", ""), "app,Tower,Lake,2024-01-07,2024-01-05,3"])
    with pytest.raises(ValueError, match="short.csv has no column for mobile"):
        read_open_leads(spark, str(tmp_path))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.csv").write_text("")
    with pytest.raises(ValueError, match="no sheet with a header"):
        read_open_leads(spark, str(tmp_path / "none"))


def test_malformed_rows_with_their_file_and_record(spark, tmp_path):
    write(tmp_path, "a.csv", [OPEN_DOTTED, "9000000001,app,a,b,2024-01-07,2024-01-05,3", "9000000002,app", '"9",a,b,c,d,e,f,g,h'])
    write(tmp_path, "b.csv", ["Extra," + OPEN_DOTTED, "x,9000000003,app,a,b,2024-01-07,2024-01-05,3", "x,y"])
    kept, apart = read_open_sheets(spark, str(tmp_path)), read_open_sheets(spark, str(tmp_path), set_aside=True)
    assert kept.leads.count() == 5 and apart.leads.count() == 2
    for sheets in (kept, apart):
        bad = sorted((r.file.rsplit("/", 1)[1], r.record) for r in sheets.malformed.collect())
        assert bad == [("a.csv", '"9",a,b,c,d,e,f,g,h'), ("a.csv", "9000000002,app"), ("b.csv", "x,y")]
    assert {r.mobile for r in apart.leads.collect()} == {9000000001, 9000000003}
    assert read_call_sheets(spark, write(tmp_path, "call.csv", [HEADER])).malformed.count() == 0
