"""Small text helpers for writing the DuckDB oracle queries."""

from __future__ import annotations

from flowlens.functions.exprs import sig_sql

FLOWS_5G_NUMERIC = ["UniqueID", "Seq", "Dur", "TotPkts", "SrcPkts", "TotBytes", "SrcBytes",
                    "sMeanPktSz", "dMeanPktSz", "Load", "Rate", "Loss", "dTtl", "sVid"]
FLOWS_5G_STRING = ["Proto", "State", "sDSb", "dDSb", "predicted", "Label"]
FLOWS_6G_NUMERIC = ["flow_id", "src", "dst_port", "protocol", "flow_duration", "fwd_pkts",
                    "bwd_pkts", "fwd_len_mean", "bwd_len_mean", "flow_bytes_s", "flow_packets_s",
                    "syn", "fin", "rst", "psh", "urg"]


def unpivot_sql(src: str, cols, ids=(), value_type: str = "DOUBLE", nan_to_null: bool = True) -> str:
    parts = []
    idl = "".join(f"{i}, " for i in ids)
    for x in cols:
        v = f"CAST({x} AS {value_type})"
        if nan_to_null and value_type == "DOUBLE":
            v = f"CASE WHEN isnan({v}) THEN NULL ELSE {v} END"
        parts.append(f"SELECT {idl}'{x}' AS feature, {v} AS value FROM {src}")
    return "\nUNION ALL ".join(parts)


def sig(x: str, digits: int = 9) -> str:
    return sig_sql(x, digits)
