"""Writers: table replace, day-partition upsert, JDBC, ad-log lines; manifests of outputs that appear together."""

from clickpulse.sinks.files import SharedFiles
from clickpulse.sinks.manifests import Manifests
from clickpulse.sinks.writers import replace_table, upsert_partitions, with_task_id, write_ad_log, write_jdbc

__all__ = ["replace_table", "upsert_partitions", "write_jdbc", "write_ad_log", "with_task_id", "Manifests", "SharedFiles"]
