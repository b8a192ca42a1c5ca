"""Sources: delimited files, whole documents, JSON/XML/HTML shredding, load gates."""

from lakefold.sources.files import (  # noqa: F401
    accepted, rejected, scan_csv, scan_delimited, scan_documents, scan_pipe, scan_xml_records,
)
from lakefold.sources.documents import (  # noqa: F401
    invoice_elements, invoice_elements_from_json, json_array_rows, project_elements, task_elements, xml_to_json,
)
from lakefold.sources.records import scan_json_documents, scan_xml_documents  # noqa: F401
from lakefold.sources.html import html_table, html_table_status  # noqa: F401
from lakefold.sources.gates import strict_timestamp  # noqa: F401
