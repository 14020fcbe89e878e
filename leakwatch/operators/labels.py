"""Labels and cleaning of flow rows."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from leakwatch.functions import columns as C
from leakwatch.functions import fixed

CSV_NAMES = {
    "fwd_bytes": "Total Length of Fwd Packets",
    "bwd_bytes": "Total Length of Bwd Packets",
    "duration": "Flow Duration",
    "psh": "PSH Flag Count",
    "fwd_packets": "Total Fwd Packets",
    "bwd_packets": "Total Backward Packets",
}


def label_code(label, positive=None):
    """1 for the positive labels, 0 for every other one, other attacks included."""
    text = F.trim(F.coalesce(label.cast("string"), F.lit("")))
    return text.isin(*(positive or fixed.POSITIVE_LABELS)).cast("int")


def upload_ratio(fwd, bwd):
    return C.clip(C.finite(fwd) / C.zero_to_one(C.finite(bwd)), 0.0, 100.0)


def push_share(psh, fwd_packets, bwd_packets):
    packets = C.zero_to_one(C.finite(fwd_packets) + C.finite(bwd_packets))
    return C.clip(C.finite(psh) / packets, 0.0, 1.0)


def heuristic(names):
    """Much more up than down, short, and often pushed."""
    c = {k: F.col(f"`{v}`") for k, v in names.items()}
    return (
        (upload_ratio(c["fwd_bytes"], c["bwd_bytes"]) > fixed.HEURISTIC_RATIO)
        & (C.finite(c["duration"]) < fixed.HEURISTIC_DURATION_US)
        & (push_share(c["psh"], c["fwd_packets"], c["bwd_packets"]) > fixed.HEURISTIC_PSH)
    )


def assign_labels(flows, label="Label", names=None, positive=None):
    """exfil_label: from the label text, else from the heuristic (it only adds)."""
    known = label_code(F.col(f"`{label}`"), positive)
    guessed = heuristic({**CSV_NAMES, **(names or {})}).cast("int")
    return flows.withColumn("exfil_label", F.greatest(known, guessed))


def numeric_columns(flows, excluded=None):
    """Numeric feature columns, metadata and known-bad ones left out."""
    out = set(excluded or fixed.METADATA_COLUMNS) | set(fixed.BAD_COLUMNS)
    return [
        f.name
        for f in flows.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in out
    ]


def clean_columns(flows, names, fill=0.0):
    """The named columns with null, NaN and infinity replaced."""
    return flows.withColumns({n: C.finite(F.col(f"`{n}`"), fill) for n in names})


def drop_zero_rows(flows, names):
    """Keep rows in which some feature is not 0."""
    return flows.filter(C.total([F.abs(F.col(f"`{n}`")) for n in names]) > 0)


def clean_features(flows, label="exfil_label", keep=()):
    """Bad columns dropped, numeric features made finite, all-zero rows removed."""
    names = [n for n in numeric_columns(flows) if n not in keep]
    picked = flows.select(*keep, *[f"`{n}`" for n in names], label)
    return drop_zero_rows(clean_columns(picked, names), names), names


def normal_only(rows, label="label"):
    return rows.filter(F.col(label) == 0)


def derived_columns(flows, names=None):
    """Upload ratio, push share and their logarithms."""
    n = {**CSV_NAMES, **(names or {})}
    c = {k: F.col(f"`{v}`") for k, v in n.items()}
    ratio = upload_ratio(c["fwd_bytes"], c["bwd_bytes"])
    share = push_share(c["psh"], c["fwd_packets"], c["bwd_packets"])
    return flows.withColumns(
        {
            "upload_ratio": ratio,
            "psh_ratio": share,
            "log_upload_ratio": F.log1p(ratio),
            "log_duration": F.log1p(C.clip(C.finite(c["duration"]), 0.0, 1e12)),
        }
    )


def upload_subset(flows):
    """The 12 upload-related columns."""
    return flows.select(*[f"`{n}`" for n in fixed.UPLOAD_FEATURES])
