"""Summarise the executed physical plans of the headline queries.

usage: python tools/plans_report.py [sf_dir] > PLANS_summary.txt
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.plans.catalog import QUERIES  # noqa: E402
from quire.session import local_session  # noqa: E402

NAMES = ["tokenise_codepoint", "tokenise_word", "pack_global", "pack_batch", "split_test", "mix_tokens",
         "batch_rows", "perplexity", "decode_roundtrip", "turn_pairs", "render_chat", "last_wins",
         "low_rank", "line_numbers", "first_source"]


def summary(p: str) -> dict:
    p = p.split("== Initial Plan ==")[0]          # AQE prints the final plan first
    lines = p.splitlines()
    return {
        "shuffles": sum(1 for l in lines if re.search(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition|\bExchange RoundRobin", l)),
        "broadcasts": sum(1 for l in lines if "BroadcastExchange" in l),
        "windows": sum(1 for l in lines if re.search(r"\bWindow \[", l)),
        "python": sum(1 for l in lines if re.search(r"MapInArrow|MapInPandas|ArrowEvalPython|PythonMapInArrow", l)),
        "scans": sorted({m.group(1) for l in lines for m in [re.search(r"ReadSchema: (struct<[^>]*>)", l)] if m}),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(shuffle_partitions=8)
    for name in NAMES:
        df = QUERIES[name](spark, sf)
        df.collect()
        s = summary(df._jdf.queryExecution().executedPlan().toString())
        print(f"{name:20s} shuffles={s['shuffles']} broadcasts={s['broadcasts']} windows={s['windows']} "
              f"python={s['python']} scans={'; '.join(s['scans'])}")


if __name__ == "__main__":
    main()
