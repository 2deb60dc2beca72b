"""The layers: staging, silver, gold, reports, and the runner that publishes them."""
