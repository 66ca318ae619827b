"""Writers: message lines and versioned snapshots."""
