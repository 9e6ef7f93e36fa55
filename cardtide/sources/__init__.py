"""Where transactions come from and where they are stored."""
