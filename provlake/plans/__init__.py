"""provlake.plans"""
