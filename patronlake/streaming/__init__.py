"""The event feed as a stream: cleaning, duplicate removal, daily counts."""
