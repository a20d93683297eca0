"""Named deliverables of the warehouse (staging, dims, fact, marts, views,
reports, chart datasets, quality checks)."""
