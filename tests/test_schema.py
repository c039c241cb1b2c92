import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from quayside.functions.schema import column_spec_to_schema


def spec(*pairs):
    return [{"column_name": n, "data_type": t} for n, t in pairs]


def test_parity_two_type_mapping(spark):
    s = column_spec_to_schema(spec(("a", "string"), ("b", "decimal(12,2)"), ("c", "int"), ("d", "date")), parity=True)
    assert [f.dataType for f in s.fields] == [T.StringType(), T.DecimalType(12, 2), T.StringType(), T.StringType()]
    assert all(f.nullable for f in s.fields)


def test_parity_decimal_without_scale_is_default(spark):
    # Precision without scale (or no precision at all) gives the default decimal(10,0)
    s = column_spec_to_schema(spec(("a", "decimal(12)"), ("b", "decimal"), ("c", "decimal(5)")), parity=True)
    assert [f.dataType for f in s.fields] == [T.DecimalType(10, 0)] * 3


def test_parity_prefix_is_case_sensitive(spark):
    # Upper-case DECIMAL is not recognised in parity mode
    s = column_spec_to_schema(spec(("a", "DECIMAL(12,2)"),), parity=True)
    assert s.fields[0].dataType == T.StringType()


def test_ddl_mode_honours_types(spark):
    s = column_spec_to_schema(
        spec(("a", "decimal(12)"), ("b", "DECIMAL(12,2)"), ("c", "date"), ("d", "int"), ("e", "array<int>"), ("f", "map<string,int>"))
    )
    assert [f.dataType for f in s.fields] == [
        T.DecimalType(12, 0), T.DecimalType(12, 2), T.DateType(), T.IntegerType(),
        T.ArrayType(T.IntegerType()), T.MapType(T.StringType(), T.IntegerType()),
    ]


def test_names_kept_and_duplicates_rejected(spark):
    s = column_spec_to_schema(spec(("first name", "string"),))
    assert s.fieldNames() == ["first name"]  # E3: spaces are not stripped
    with pytest.raises(ValueError):
        column_spec_to_schema(spec(("a", "string"), ("A", "int")))
    with pytest.raises(ValueError):
        column_spec_to_schema([])


type_texts = st.one_of(
    st.sampled_from(["string", "int", "bigint", "date", "timestamp", "double", "DECIMAL(9,2)", "Decimal(4,1)"]),
    st.tuples(st.integers(1, 38), st.integers(0, 10)).filter(lambda t: t[1] <= t[0]).map(lambda t: f"decimal({t[0]},{t[1]})"),
    st.integers(1, 38).map(lambda p: f"decimal({p})"),
)


@settings(max_examples=60, deadline=None)
@given(st.lists(type_texts, min_size=1, max_size=8))
def test_parity_property(types):
    s = column_spec_to_schema([{"column_name": f"c{i}", "data_type": t} for i, t in enumerate(types)], parity=True)
    for t, f in zip(types, s.fields):
        if not t.startswith("decimal"):
            assert f.dataType == T.StringType()
        elif "," in t:
            p, sc = t[t.index("(") + 1:-1].split(",")
            assert f.dataType == T.DecimalType(int(p), int(sc))
        else:
            assert f.dataType == T.DecimalType(10, 0)
