"""The jobs as streams, and triggers that fire by count and by the clock."""
