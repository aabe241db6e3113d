"""Named queries over the warehouse tables and their reference SQL."""
