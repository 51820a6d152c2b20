"""What a user runs: loads, marts, views, documents and the full refresh."""
