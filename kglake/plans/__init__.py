"""Multi-step jobs and the shared-storage helpers they rely on."""
