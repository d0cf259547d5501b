"""Schemas, fixed tables and parameter sets shared by every operator."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# Flow-file column -> canonical training column, in model order.
# The leading spaces are part of the canonical names.
FEATURE_MAP: tuple[tuple[str, str], ...] = (
    ("Dst Port", " Destination Port"),
    ("Flow Duration", " Flow Duration"),
    ("Tot Fwd Pkts", " Total Fwd Packets"),
    ("Tot Bwd Pkts", " Total Backward Packets"),
    ("TotLen Fwd Pkts", "Total Length of Fwd Packets"),
    ("TotLen Bwd Pkts", " Total Length of Bwd Packets"),
    ("Fwd Pkt Len Max", " Fwd Packet Length Max"),
    ("Fwd Pkt Len Min", " Fwd Packet Length Min"),
    ("Fwd Pkt Len Mean", " Fwd Packet Length Mean"),
    ("Fwd Pkt Len Std", " Fwd Packet Length Std"),
    ("Bwd Pkt Len Max", "Bwd Packet Length Max"),
    ("Bwd Pkt Len Min", " Bwd Packet Length Min"),
    ("Bwd Pkt Len Mean", " Bwd Packet Length Mean"),
    ("Bwd Pkt Len Std", " Bwd Packet Length Std"),
    ("Flow Byts/s", "Flow Bytes/s"),
    ("Flow Pkts/s", " Flow Packets/s"),
    ("Flow IAT Mean", " Flow IAT Mean"),
    ("Flow IAT Std", " Flow IAT Std"),
    ("Flow IAT Max", " Flow IAT Max"),
    ("Flow IAT Min", " Flow IAT Min"),
    ("Fwd IAT Tot", "Fwd IAT Total"),
    ("Fwd IAT Mean", " Fwd IAT Mean"),
    ("Fwd IAT Std", " Fwd IAT Std"),
    ("Fwd IAT Max", " Fwd IAT Max"),
    ("Fwd IAT Min", " Fwd IAT Min"),
    ("Bwd IAT Tot", "Bwd IAT Total"),
    ("Bwd IAT Mean", " Bwd IAT Mean"),
    ("Bwd IAT Std", " Bwd IAT Std"),
    ("Bwd IAT Max", " Bwd IAT Max"),
    ("Bwd IAT Min", " Bwd IAT Min"),
    ("Fwd PSH Flags", "Fwd PSH Flags"),
    ("Bwd PSH Flags", " Bwd PSH Flags"),
    ("Fwd URG Flags", " Fwd URG Flags"),
    ("Bwd URG Flags", " Bwd URG Flags"),
    ("Fwd Header Len", " Fwd Header Length"),
    ("Bwd Header Len", " Bwd Header Length"),
    ("Fwd Pkts/s", "Fwd Packets/s"),
    ("Bwd Pkts/s", " Bwd Packets/s"),
    ("Pkt Len Min", " Min Packet Length"),
    ("Pkt Len Max", " Max Packet Length"),
    ("Pkt Len Mean", " Packet Length Mean"),
    ("Pkt Len Std", " Packet Length Std"),
    ("Pkt Len Var", " Packet Length Variance"),
    ("FIN Flag Cnt", "FIN Flag Count"),
    ("SYN Flag Cnt", " SYN Flag Count"),
    ("RST Flag Cnt", " RST Flag Count"),
    ("PSH Flag Cnt", " PSH Flag Count"),
    ("ACK Flag Cnt", " ACK Flag Count"),
    ("URG Flag Cnt", " URG Flag Count"),
    ("CWE Flag Count", " CWE Flag Count"),
    ("ECE Flag Cnt", " ECE Flag Count"),
    ("Down/Up Ratio", " Down/Up Ratio"),
    ("Pkt Size Avg", " Average Packet Size"),
    ("Fwd Seg Size Avg", " Avg Fwd Segment Size"),
    ("Bwd Seg Size Avg", " Avg Bwd Segment Size"),
    ("Fwd Header Len_dup", " Fwd Header Length.1"),
    ("Fwd Byts/b Avg", "Fwd Avg Bytes/Bulk"),
    ("Fwd Pkts/b Avg", " Fwd Avg Packets/Bulk"),
    ("Fwd Blk Rate Avg", " Fwd Avg Bulk Rate"),
    ("Bwd Byts/b Avg", " Bwd Avg Bytes/Bulk"),
    ("Bwd Pkts/b Avg", " Bwd Avg Packets/Bulk"),
    ("Bwd Blk Rate Avg", "Bwd Avg Bulk Rate"),
    ("Subflow Fwd Pkts", "Subflow Fwd Packets"),
    ("Subflow Fwd Byts", " Subflow Fwd Bytes"),
    ("Subflow Bwd Pkts", " Subflow Bwd Packets"),
    ("Subflow Bwd Byts", " Subflow Bwd Bytes"),
    ("Init Fwd Win Byts", "Init_Win_bytes_forward"),
    ("Init Bwd Win Byts", " Init_Win_bytes_backward"),
    ("Fwd Act Data Pkts", " act_data_pkt_fwd"),
    ("Fwd Seg Size Min", " min_seg_size_forward"),
    ("Active Mean", "Active Mean"),
    ("Active Std", " Active Std"),
    ("Active Max", " Active Max"),
    ("Active Min", " Active Min"),
    ("Idle Mean", "Idle Mean"),
    ("Idle Std", " Idle Std"),
    ("Idle Max", " Idle Max"),
    ("Idle Min", " Idle Min"),
    ("Label", " Label"),
)

# Fixed value: the one source name that re-reads another column.
REREAD = {"Fwd Header Len_dup": "Fwd Header Len"}


def internal_name(canonical: str) -> str:
    """Canonical training column -> snake_case column used inside the package."""
    name = canonical.strip().lower().replace("/s", "_per_s")
    return re.sub(r"[^a-z0-9]+", "_", name).strip("_")


CANONICAL = tuple(c for _, c in FEATURE_MAP)
INTERNAL = tuple(internal_name(c) for c in CANONICAL)
LABEL = "label"
FEATURES = tuple(c for c in INTERNAL if c != LABEL)

# Identity columns of a flow file: source name, internal name, type, default.
IDENTITY = (
    ("Src IP", "src_ip", "string", "unknown"),
    ("Dst IP", "dst_ip", "string", "unknown"),
    ("Src Port", "src_port", "int", 0),
    ("Dst Port", "dst_port", "int", 0),
    ("Protocol", "protocol", "int", 0),
    ("Timestamp", "flow_ts", "string", ""),
    ("Flow Duration", "duration", "double", 0.0),
)

# Confidence histogram keys with their lower and upper bound.
BUCKETS = (
    ("0.50-0.60", 0.50, 0.60),
    ("0.60-0.70", 0.60, 0.70),
    ("0.70-0.80", 0.70, 0.80),
    ("0.80-0.90", 0.80, 0.90),
    ("0.90-1.00", 0.90, 1.00),
)

# Severity by number of flows, strongest first.
SEVERITY = (("CRITICAL", 100), ("HIGH", 50), ("MEDIUM", 10))
SEVERITY_FLOOR = "LOW"
ATTACK_TYPE = "SSH_BRUTE_FORCE"
ATTACK_LABEL = "SSH-Patator"
BENIGN_LABEL = "BENIGN"


@dataclass(frozen=True)
class Tier:
    name: str
    min_confidence: float
    seconds: int | None  # None = never expires
    alias: str


# Block tiers, weakest first.
TIERS = (
    Tier("30min", 0.70, 1800, "ssh_block_30min"),
    Tier("8hours", 0.75, 28800, "ssh_block_8hours"),
    Tier("24hours", 0.85, 86400, "ssh_block_24hours"),
    Tier("permanent", 0.95, None, "ssh_block_permanent"),
)
CONFIDENCE_FLOOR = 0.70


@dataclass(frozen=True)
class DetectConfig:
    threshold: float = 0.70
    min_attack_flows: int = 1
    window_files: int = 5
    window_mode: str = "rolling"
    ssh_only: bool = False
    ssh_port: int = 22
    model_type: str = "RandomForestClassifier"


@dataclass(frozen=True)
class ForestConfig:
    trees: int = 100
    depth: int = 20
    min_leaf: int = 2
    max_bins: int = 128
    seed: int = 42
    fit_rows: int = 5_000_000


@dataclass(frozen=True)
class RetryConfig:
    interval_seconds: int = 30
    max_attempts: int = 5


CONFIDENCE_TYPE = T.StructType(
    [
        T.StructField("average", T.DoubleType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("breakdown", T.MapType(T.StringType(), T.LongType())),
    ]
)

ALERT_FLOW_TYPE = T.StructType(
    [
        T.StructField("flow_index", T.LongType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("flow_duration", T.DoubleType()),
    ]
)

TARGET_TYPE = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("port", T.IntegerType()),
        T.StructField("flow_count", T.LongType()),
    ]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("attacker_ip", T.StringType()),
        T.StructField("attack_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("total_flows", T.LongType()),
        T.StructField("confidence", CONFIDENCE_TYPE),
        T.StructField("flows", T.ArrayType(ALERT_FLOW_TYPE)),
        T.StructField("source_csvs", T.ArrayType(T.StringType())),
        T.StructField("targets", T.ArrayType(TARGET_TYPE)),
        T.StructField("part", T.IntegerType()),
        T.StructField("alert_file", T.StringType()),
    ]
)

WHITELIST_ENTRY = "map<string,struct<reason:string,added:string,added_by:string>>"

BLOCK_SCHEMA = (
    "ip string, blocked_at timestamp, unblock_at timestamp, tier string, alias string, "
    "confidence_avg double, total_flows bigint, alert_id string, alert_file string, "
    "status string, attempt_count bigint, last_attempt timestamp"
)
HISTORY_SCHEMA = (
    "ip string, blocked_at timestamp, unblocked_at timestamp, tier string, "
    "confidence_avg double, total_flows bigint, attempts bigint, month string"
)
INVENTORY_SCHEMA = "path string, length bigint, modificationTime timestamp"
PACKET_SCHEMA = (
    "ts timestamp, src_ip string, src_port int, dst_ip string, dst_port int, protocol int, "
    "length int, header_length int, payload_length int, tcp_flags int, win int"
)


def raw_flow_schema(header: list[str] | None = None) -> T.StructType:
    """All-string schema of a flow file; numbers are cast later so that `inf` survives the parser."""
    names = header
    if names is None:
        names = ["Flow ID"] + [s for s, *_ in IDENTITY]
        names += [s for s, _ in FEATURE_MAP if s not in names and s not in REREAD]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
