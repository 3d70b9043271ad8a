from candlewick import schema


def test_symbols_unique_upper_usdt():
    assert len(schema.SYMBOLS) == 10
    assert len(set(schema.SYMBOLS)) == 10
    assert all(s == s.upper() and s.endswith("USDT") for s in schema.SYMBOLS)


def test_column_groups_are_fields_and_disjoint():
    assert set(schema.NUMERIC_COLS) <= set(schema.FIELDNAMES)
    assert set(schema.TIME_COLS) <= set(schema.FIELDNAMES)
    assert not set(schema.NUMERIC_COLS) & set(schema.TIME_COLS)
    assert set(schema.VOLUME_COLS) <= set(schema.NUMERIC_COLS)
    assert len(schema.FIELDNAMES) == 13


def test_schemas_follow_field_order():
    assert [f.name for f in schema.RAW_SCHEMA.fields] == schema.FIELDNAMES
    assert [f.name for f in schema.CANDLE_SCHEMA.fields] == schema.FIELDNAMES
    assert [f.name for f in schema.CLEANED_SCHEMA.fields] == schema.FIELDNAMES + schema.DERIVED_COLS


def test_limits_positive():
    assert schema.LIMIT > 0 and schema.RATE_LIMIT > 0 and schema.RATE_WINDOW_SECONDS > 0 and schema.MAX_WORKERS > 0
