"""Feed schemas, file readers and the feed shapes derived from warehouse tables."""
