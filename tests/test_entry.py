"""The driver contract: entry(), queries(), oracle_sql()."""
import __spark_entry__ as E


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.schema.simpleString() == ("struct<source:string,block_id:bigint,input_ids:array<int>,"
                                        "attention_mask:array<int>,labels:array<int>>")
    rows = df.collect()
    assert rows and all(len(r.input_ids) == 256 or r.block_id == 0 for r in rows)


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 60
    assert all(callable(f) for f in q.values()) and all(isinstance(x, str) and x for x in s.values())
