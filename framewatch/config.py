"""Gate configuration: thresholds, topology and sink names.

Every operator takes a :class:`GateConfig`; nothing reads globals or the
environment, so one session can run several configurations side by side.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# These must equal the reference pipeline's settings for the
# results to agree (thresholds, window sizes, check names, reason types and
# message formats).
# ---------------------------------------------------------------------------
BRIGHTNESS_MIN_VALID = 10.0
BRIGHTNESS_MAX_VALID = 255.0
BLUR_MIN_VALID = 0.0
EMBEDDING_DIM = 128
KNOWN_CAMERAS = ("camera_1", "camera_2", "camera_3")
DRIFT_BASELINE_SAMPLES = 1000
DRIFT_WINDOW_SIZE = 20
DRIFT_ALPHA = 0.05
EXACT_KS_MAX_N = 10000  # above this sample size the p-value is that of one sample
QA_QUARANTINE_RATE_THRESHOLD = 0.15
ORCHESTRATOR_QA_WINDOW_BATCHES = 5
DRIFT_MIN_FEATURES_FOR_INCIDENT = 2
INCIDENT_SEVERITY = "critical"

CHECK_BRIGHTNESS = "_brightness_valid"
CHECK_BLUR = "_blur_valid"
CHECK_CAMERA_ID = "_camera_id_valid"
CHECK_EMBEDDING_DIM = "_embedding_has_expected_dim"
CHECK_NOT_NULL = "not_nullable"
CHECK_COERCE_FLOAT = "coerce_dtype('float64')"
CHECK_COLUMN = "column_in_dataframe"

REASON_RATE = "qa_quarantine_rate_exceeded"
REASON_DRIFT = "multi_feature_drift"
RATE_MESSAGE = "QA quarantine rate {rate} exceeds {threshold} threshold."
DRIFT_MESSAGE = "Drift detected across {count} features: {features}."
SUMMARY_PREFIX = "Circuit breaker tripped for {camera}: "

STATUS_PASSED = "passed"
STATUS_PARTIAL = "partial_failure"
STATUS_FAILED = "failed"
STATUS_ERROR = "error"

DRIFT_FEATURES = ("brightness_avg", "blur_metric", "embedding")
# ---------------------------------------------------------------------------

# Python's ``\d`` matches any Unicode digit, Java's only ASCII unless (?U) is
# set; ``\z`` (not ``$``) refuses a trailing newline, as a full match does.
CAMERA_ID_PATTERN_ASCII = r"^camera_[0-9]+\z"
CAMERA_ID_PATTERN_UNICODE = r"(?U)^camera_\d+\z"


@dataclass(frozen=True)
class GateConfig:
    brightness_min: float = BRIGHTNESS_MIN_VALID
    brightness_max: float = BRIGHTNESS_MAX_VALID
    blur_min: float = BLUR_MIN_VALID
    camera_id_pattern: str = CAMERA_ID_PATTERN_ASCII
    embedding_dim: int = EMBEDDING_DIM
    known_cameras: tuple[str, ...] = KNOWN_CAMERAS
    topology: str | None = None  # folder of a table of cameras, instead of known_cameras
    baseline_samples: int = DRIFT_BASELINE_SAMPLES
    baseline_rounds: int | None = None  # rounds that make the reference period; None: give a baseline
    drift_window: int = DRIFT_WINDOW_SIZE
    drift_alpha: float = DRIFT_ALPHA
    exact_ks_max_n: int = EXACT_KS_MAX_N
    pvalue_partitions: int = 64
    # chunking of per-camera ordered computations (bounded partitions when one
    # camera holds a large share of the rows): rounds per prefix-sum chunk,
    # positions / record ordinals per sliding-frame chunk
    chunk_rounds: int = 1024
    chunk_positions: int = 1 << 16
    chunk_records: int = 1 << 16
    rate_threshold: float = QA_QUARANTINE_RATE_THRESHOLD
    qa_window_batches: int = ORCHESTRATOR_QA_WINDOW_BATCHES
    min_drift_features: int = DRIFT_MIN_FEATURES_FOR_INCIDENT
    severity: str = INCIDENT_SEVERITY
    # Routing names are deployment settings, not logic.
    alert_channel: str = "#frame-gate-alerts"
    incident_title: str = "Frame Gate Incident"
    pager_routing_key: str = "frame-gate-production"
    source_name: str = "frame-gate-orchestrator"
    retrain_pipeline: str = "frame-model-refresh"
    retrain_engine: str = "job-queue"
    retrain_action: str = "start_run"
    retrain_dag_id: str = "refresh_frame_model"
    quarantine_dir: str = "quarantine"
    alerts_dir: str = "alerts"

    def with_(self, **kw) -> "GateConfig":
        return replace(self, **kw)


DEFAULT_CONFIG = GateConfig()

# Configuration used with the frames fixture derived from the driver tables
# (64-d embeddings, sixteen feeds camera_0..camera_15).
FIXTURE_CONFIG = GateConfig(
    embedding_dim=64,
    known_cameras=tuple(f"camera_{i}" for i in range(16)),
    baseline_rounds=7,
)
