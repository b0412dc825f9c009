"""Names, formats and defaults that results must carry unchanged."""

# Job names and folders
JOB_PREFIX = "cpp-worker-job-"
WORK_ROOT = "/cpp_work/"

# Patterns of a job name
SUB_ID_PATTERN = r"^cpp-worker-job-(\w+)-"
FAMILY_PATTERN = r"^(cpp-worker-job-\d+-\w+)"
JOB_TOTAL_PATTERN = r"^cpp-worker-job-\d+-\w+-\d+-(\d+)"
ANALYSIS_ID_PATTERN = r"^cpp-worker-job-\d+-\w+-\d+-\d+-(\d+)"

# Pattern of a batch-submission reply
BATCH_ID_PATTERN = r"Submitted batch job (\d+)"

# Keys of the settings document that choose a backend
REMOTE_KEY = "run_on_uppmax"
BACKEND_KEYS = ("run_on_uppmax", "run_on_hpcdev", "run_on_pelle")
ROLLUP_SKIP_KEYS = ("run_on_pelle", "run_on_hpcdev")

# Defaults of the settings document
DEFAULT_PRIORITY = 0
DEFAULT_TIMEOUT = "10800"
DEFAULT_SUB_TYPE = "undefifed"
DEFAULT_MAX_ERRORS = 0
DEFAULT_VERSION_CLUSTER = "v4.2.5-cellpose2.0"
DEFAULT_VERSION_REMOTE = "v4.0.7"

# Run-level tables that are not merged (substrings of the file name)
EXCLUDED_TABLES = ("qcRAW_experiment_", "icf_experiment__experiment.csv", "Experiment.csv")
INTENDED_EXCLUDED_TABLES = ("qcRAW_experiment_", "icf_experiment_", "_experiment.csv", "Experiment.csv")

# Files of a job directory that are not results
SKIPPED_SUFFIXES = ("csv", "log")
MARKER_ERROR = "error"
MARKER_FINISHED = "finished"

# Suffixes of image files
IMAGE_SUFFIXES = ("png", "jpg", "tiff", "tif")

# Tokens that pandas.read_csv takes as missing
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")

# Error texts kept with an analysis
NO_IMAGES = "No images found for the analysis with the input data ...."
EMPTY_CHANNEL_MAP = "Channel map is empty"
UNKNOWN_TYPE = "Unknown Analysis type: "
OVER_BUDGET = "error_count is more than max_errors"
JOB_ERROR = "error in job "

# Texts of our own for what would otherwise show only in a failing worker
NO_PIPELINE = "No pipeline file is named"
UNREADABLE = "Setting that cannot be read: "
