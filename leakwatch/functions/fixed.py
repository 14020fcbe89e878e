"""Names, thresholds and weights the results depend on."""

# --- Fixed values: the 17 features scored at run time, in vector order -------
RUNTIME_FEATURES = [
    "request_count",
    "total_fwd_bytes",
    "total_bwd_bytes",
    "total_bytes",
    "upload_download_ratio",
    "burst_count",
    "burst_ratio",
    "unusual_port_ratio",
    "request_rate",
    "inter_request_time_mean",
    "inter_request_time_std",
    "mean_payload_size",
    "std_payload_size",
    "psh_flag_count",
    "ack_flag_count",
    "syn_flag_count",
    "window_duration",
]

# The older 16-wide vector has no port feature.
COMPACT_FEATURES = [name for name in RUNTIME_FEATURES if name != "unusual_port_ratio"]

# --- Fixed values: all 27 features of one source and window -------------------
WINDOW_FEATURES = [
    "request_count",
    "total_fwd_bytes",
    "total_bwd_bytes",
    "total_bytes",
    "upload_download_ratio",
    "burst_count",
    "fwd_burst_count",
    "burst_ratio",
    "unusual_port_ratio",
    "request_rate",
    "inter_request_time_mean",
    "inter_request_time_std",
    "inter_request_time_min",
    "inter_request_time_max",
    "window_duration",
    "mean_payload_size",
    "std_payload_size",
    "max_payload_size",
    "mean_packet_size",
    "std_packet_size",
    "psh_flag_count",
    "ack_flag_count",
    "syn_flag_count",
    "fin_flag_count",
    "rst_flag_count",
    "unique_destinations",
    "is_long_session",
]

# --- Fixed values: weight of each run-time feature in the baseline score ------
BASELINE_WEIGHTS = {
    "request_count": 0.5,
    "total_fwd_bytes": 1.0,
    "total_bwd_bytes": 0.5,
    "total_bytes": 1.0,
    "upload_download_ratio": 2.0,
    "burst_count": 1.5,
    "burst_ratio": 1.5,
    "unusual_port_ratio": 1.5,
    "request_rate": 1.0,
    "inter_request_time_mean": 0.5,
    "inter_request_time_std": 1.0,
    "mean_payload_size": 0.5,
    "std_payload_size": 0.5,
    "psh_flag_count": 0.5,
    "ack_flag_count": 0.0,
    "syn_flag_count": 0.0,
    "window_duration": 0.0,
}
Z_THRESHOLD = 2.0
Z_CAP = 10.0
STD_FLOOR = 1e-8
ONLINE_THRESHOLD = 0.5
WARMUP_WINDOWS = 10

# --- Fixed values: packets and windows ----------------------------------------
HTTP_PORTS = [80, 443, 8000, 8080, 8443]
SERVICE_PORTS = [80, 443, 8080, 8443, 53, 22, 21, 25, 110, 143, 993, 995, 587, 465]
EPHEMERAL_FLOOR = 49152
TCP_FLAG_BITS = {"FIN": 1, "SYN": 2, "RST": 4, "PSH": 8, "ACK": 16, "URG": 32}
BURST_GAP_US = 100_000
WINDOW_SECONDS = 60
TRAINING_WINDOW_SECONDS = 10
MIN_PACKETS = 3
LONG_SESSION_SECONDS = 300

# --- Fixed values: rule score and severity ------------------------------------
RULE_LIMITS = {
    "upload_ratio": 100.0,
    "total_bytes": 50_000,
    "burst_count": 50,
    "unusual_port": 0.8,
    "iat_std": 0.05,
    "min_requests": 5,
}
RULE_WEIGHTS = {"upload_ratio": 0.40, "burst_count": 0.20, "unusual_port": 0.20, "iat_std": 0.20}
RULE_ALERT_THRESHOLD = 0.7
SEVERITY_FLOORS = [("CRITICAL", 0.85), ("HIGH", 0.70), ("MEDIUM", 0.50), ("LOW", 0.30)]
TRIGGER_LABELS = {
    "BURST_RULE": "Burst exfil score",
    "OFFLINE_MODEL": "Offline model",
    "ONLINE_UNKNOWN_ANOMALY": "Online anomaly (unknown pattern)",
}

# --- Fixed values: flow tables -------------------------------------------------
POSITIVE_LABELS = ["Bot", "Infiltration"]
FLOW_FILES = {
    "monday": "Monday-WorkingHours.pcap_ISCX.csv",
    "tuesday": "Tuesday-WorkingHours.pcap_ISCX.csv",
    "wednesday": "Wednesday-workingHours.pcap_ISCX.csv",
    "thu_am": "Thursday-WorkingHours-Morning-WebAttacks.pcap_ISCX.csv",
    "thu_pm": "Thursday-WorkingHours-Afternoon-Infilteration.pcap_ISCX.csv",
    "fri_am": "Friday-WorkingHours-Morning.pcap_ISCX.csv",
    "fri_pm_ps": "Friday-WorkingHours-Afternoon-PortScan.pcap_ISCX.csv",
    "fri_pm_dd": "Friday-WorkingHours-Afternoon-DDos.pcap_ISCX.csv",
}
BAD_COLUMNS = [
    "Fwd Header Length",
    "Bwd Header Length",
    "Fwd Header Length.1",
    "min_seg_size_forward",
    "Fwd Avg Bytes/Bulk",
    "Fwd Avg Packets/Bulk",
    "Fwd Avg Bulk Rate",
    "Bwd Avg Bytes/Bulk",
    "Bwd Avg Packets/Bulk",
    "Bwd Avg Bulk Rate",
]
METADATA_COLUMNS = [
    "Label",
    "exfil_label",
    "_source_file",
    "Source IP",
    "Destination IP",
    "Source Port",
    "Destination Port",
    "Protocol",
    "Timestamp",
]
FLOW_FEATURES = [
    "Flow Duration",
    "Total Fwd Packets",
    "Total Backward Packets",
    "Total Length of Fwd Packets",
    "Total Length of Bwd Packets",
    "Fwd Packet Length Max",
    "Fwd Packet Length Min",
    "Fwd Packet Length Mean",
    "Fwd Packet Length Std",
    "Bwd Packet Length Max",
    "Bwd Packet Length Min",
    "Bwd Packet Length Mean",
    "Bwd Packet Length Std",
    "Min Packet Length",
    "Max Packet Length",
    "Packet Length Mean",
    "Packet Length Std",
    "Flow Bytes/s",
    "Flow Packets/s",
    "Fwd Packets/s",
    "Bwd Packets/s",
    "Flow IAT Mean",
    "Flow IAT Std",
    "Flow IAT Max",
    "Flow IAT Min",
    "Fwd IAT Mean",
    "Fwd IAT Std",
    "Fwd IAT Max",
    "Fwd IAT Min",
    "Bwd IAT Mean",
    "Bwd IAT Std",
    "Bwd IAT Max",
    "Bwd IAT Min",
    "FIN Flag Count",
    "SYN Flag Count",
    "RST Flag Count",
    "PSH Flag Count",
    "ACK Flag Count",
    "URG Flag Count",
    "Avg Fwd Segment Size",
    "Avg Bwd Segment Size",
    "Init_Win_bytes_forward",
    "Init_Win_bytes_backward",
    "Active Mean",
    "Active Std",
    "Active Max",
    "Active Min",
    "Idle Mean",
    "Idle Std",
    "Idle Max",
    "Idle Min",
    "Subflow Fwd Packets",
    "Subflow Fwd Bytes",
    "Subflow Bwd Packets",
    "Subflow Bwd Bytes",
    "act_data_pkt_fwd",
    "Down/Up Ratio",
    "Average Packet Size",
]
CUSTOM_FLOW_FEATURES = [
    "upload_download_ratio",
    "burst_count",
    "burst_ratio",
    "unusual_port_ratio",
    "inter_request_time_std",
    "requests_per_second",
    "is_long_session",
]
UPLOAD_FEATURES = [
    "Total Length of Fwd Packets",
    "Subflow Fwd Bytes",
    "Avg Fwd Segment Size",
    "Fwd Packet Length Mean",
    "Fwd Packet Length Std",
    "Down/Up Ratio",
    "Fwd Packets/s",
    "Flow Bytes/s",
    "Flow IAT Std",
    "Flow IAT Mean",
    "PSH Flag Count",
    "ACK Flag Count",
]
CORRELATION_FEATURES = [
    "Total Length of Fwd Packets",
    "Total Length of Bwd Packets",
    "Total Fwd Packets",
    "Total Backward Packets",
    "Flow Duration",
    "Flow Bytes/s",
    "Flow Packets/s",
    "Fwd Packet Length Mean",
    "Bwd Packet Length Mean",
    "Packet Length Variance",
    "Average Packet Size",
    "PSH Flag Count",
    "ACK Flag Count",
    "SYN Flag Count",
    "Subflow Fwd Bytes",
    "Subflow Bwd Bytes",
]
SCENARIOS = {
    "baseline": (0, "Normal traffic"),
    "burst_exfil": (1, "Burst exfiltration"),
    "slow_exfil": (1, "Slow exfiltration"),
    "https_exfil": (1, "HTTPS metadata exfil"),
}

# --- Fixed values: heuristic label and proxy score ------------------------------
HEURISTIC_RATIO = 5.0
HEURISTIC_PSH = 0.3
HEURISTIC_DURATION_US = 600_000_000

# --- Fixed values: dataset preparation, evaluation and models --------------------
SPLIT_SHARES = {"train": 0.70, "test": 0.15, "val": 0.15}
SEED = 42
MAX_FPR = 0.05
TARGET_RECALL = 0.85
SCAN_RANGE = (0.001, 0.999)
IMPROVE_RANGE = (0.01, 0.99)
KEY_THRESHOLDS = [0.50, 0.60, 0.70, 0.75, 0.80, 0.85, 0.88, 0.90, 0.92, 0.95, 0.97]
SENSITIVITY_THRESHOLDS = [0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90]
ISOLATION_TREES = 200
ISOLATION_SAMPLE = 256
CONTAMINATION = 0.05
FOREST = {"numTrees": 120, "maxDepth": 8, "minInstancesPerNode": 2}
FOREST_THRESHOLD = 0.8
DENSE_LAYERS = [64, 32, 64]
MAX_UPLOAD_BYTES = 10 * 1024 * 1024
