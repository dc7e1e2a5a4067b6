"""Named jobs and queries: silver and gold jobs, labels, analytics pages, quality reports."""
