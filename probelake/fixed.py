"""They must be exactly these for the results to be right."""

# --- landing -----------------------------------------------------------------
TEST_TYPE = "web_connectivity"
LANDING_COUNTRIES = ("BR", "DE", "RU", "US")
MIN_FILE_MIB = 0.3
COUNTRY_LIMIT_MIB = 100.0
SMALL_COUNTRY_LIMIT_MIB = 1.5
MIB = 1024 * 1024

# --- patterns ----------------------------------------------------------------
IPV4_PATTERN = r"^((25[0-5]|(2[0-4]|1\d|[1-9]|)\d)\.?\b){4}$"
URL_PATTERN = r"^(https?:\/\/)?([\da-z\.-]+)\.([a-z\.]{2,6})([\/\w \.-]*)*\/?$"
TITLE_PATTERN = r"<title.*?>(.*?)</title>"
META_TITLE_PATTERN = r'<meta.*?property="og:title".*?content="(.*?)"'
NETLOC_PATTERN = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"

# --- quality check -----------------------------------------------------------
CHECK_NAME = "Review Check"
CHECK_LEVEL = "Warning"
STATUS_SUCCESS = "Success"
STATUS_WARNING = "Warning"
STATUS_FAILURE = "Failure"

COMPLETENESS = {
    "id": 0.9,
    "probe_asn": 0.9,
    "probe_cc": 0.98,
    "probe_ip": 0.9,
    "test_start_time": 0.9,
    "test_name": 0.9,
    "bucket_date": 0.98,
    "measurement_start_time": 0.9,
}
VALIDITY_COMPLETENESS = {"is_ip_valid": 0.9, "is_url_valid": 0.9}
COUNTRIES_4 = ("BR", "RU", "US", "DE")
COUNTRIES_9 = ("BR", "CN", "FR", "RU", "GB", "US", "DE", "IN", "AR")

# --- tables ------------------------------------------------------------------
WIDE_COLUMNS = ("queries", "answers", "requests", "control")

MEASUREMENT_DDL = """
test_keys struct<
  accessible string, agent string, blocking string, body_length_match string,
  body_proportion double, client_resolver string,
  control struct<
    dns struct<addrs array<string>, failure string>,
    http_request struct<
      body_length bigint, failure string,
      headers struct<
        `Accept-Ranges` string, `CF-RAY` string, `Cache-Control` string, `Content-Language` string,
        `Content-Location` string, `Content-Type` string, `Date` string, `ETag` string, `Expires` string,
        `Last-Modified` string, `Server` string, `Set-Cookie` string, `Strict-Transport-Security` string,
        `TCN` string, `Vary` string, `X-Content-Type-Options` string, `X-Frame-Options` string,
        `X-Xss-Protection` string, `content-encoding` string>,
      status_code bigint, title string>>,
  control_failure string, dns_consistency string, dns_experiment_failure string,
  headers_match string, http_experiment_failure string,
  queries array<struct<
    answers array<struct<answer_type string, ipv4 string>>,
    failure string, hostname string, query_type string, resolver_hostname string, resolver_port string>>,
  requests array<struct<
    failure string,
    request struct<
      body string,
      headers struct<`Accept` string, `Accept-Language` string, `User-Agent` string>,
      method string,
      tor struct<exit_ip string, exit_name string, is_tor string>,
      url string>,
    response struct<
      body string, code bigint,
      headers struct<
        `Accept-Ranges` string, `Cache-Control` string, `Content-Language` string, `Content-Location` string,
        `Content-Type` string, `Date` string, `ETag` string, `Expires` string, `Last-Modified` string,
        `Location` string, `Server` string, `Strict-Transport-Security` string, `TCN` string, `Vary` string,
        `X-Content-Type-Options` string, `X-Frame-Options` string, `X-Xss-Protection` string,
        `content-encoding` string>>>>,
  retries bigint, socksproxy string, status_code_match string,
  tcp_connect array<struct<
    ip string, port bigint, status struct<blocked string, failure string, success string>>>,
  title_match string>,
annotations struct<platform string>,
backend_version string, bucket_date string, data_format_version string, id string, input string,
input_hashes array<string>, measurement_start_time string, options array<string>,
probe_asn string, probe_cc string, probe_city string, probe_ip string, report_filename string,
report_id string, software_name string, software_version string,
test_helpers struct<backend struct<address string, type string>>,
test_name string, test_runtime double, test_start_time string, test_version string
"""

# Output column -> field of the measurement document, in table order.
TRUSTED_PROJECTION = {
    "id": "id",
    "input": "input",
    "measurement_start_time": "measurement_start_time",
    "test_start_time": "test_start_time",
    "probe_asn": "probe_asn",
    "probe_cc": "probe_cc",
    "probe_ip": "probe_ip",
    "report_id": "report_id",
    "software_name": "software_name",
    "software_version": "software_version",
    "test_name": "test_name",
    "test_runtime": "test_runtime",
    "test_version": "test_version",
    "bucket_date": "bucket_date",
    "queries": "test_keys.queries",
    "control_failure": "test_keys.control_failure",
    "blocking": "test_keys.blocking",
    "http_experiment_failure": "test_keys.http_experiment_failure",
    "tcp_connect": "test_keys.tcp_connect",
    "requests": "test_keys.requests",
    "control": "test_keys.control",
    "dns_experiment_failure": "test_keys.dns_experiment_failure",
    "platform": "annotations.platform",
}

DELIVERY_TABLE_DDL = """
id string, measurement_start_time timestamp, test_start_time timestamp, probe_asn string, probe_ip string,
report_id string, test_name string, control_failure string, blocking string, http_experiment_failure string,
dns_experiment_failure string, platform string, domain string, http_title string, http_meta_title string,
probe_cc string
"""

QUALITY_LOG_DDL = """
check string, check_level string, check_status string, constraint string, constraint_status string,
constraint_message string, bucket_date string
"""
