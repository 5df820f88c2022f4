"""Where tables go: staged datasets, warehouse tables, views."""
