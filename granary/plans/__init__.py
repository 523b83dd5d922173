"""granary.plans"""
